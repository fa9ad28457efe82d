"""All data-quality checks of a planning cycle, as one table of counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.quality import (
    TableChecks,
    check_table,
    key_uniqueness,
    label,
    multi_site_materials,
    non_negative,
    not_above,
    orphans,
    union_all,
    unpivot,
)
from shelfcast.sources.tables import INPUTS, PlanningTables

CHECKS: dict[str, TableChecks] = {
    "materials": TableChecks(keys=["Material_ID"]),
    "customers": TableChecks(keys=["Customer_ID"]),
    "actuals": TableChecks(
        keys=["Demand_Month", "Customer_ID", "Material_ID"],
        required=["Demand_Month", "Customer_ID", "Material_ID", "Actual_Demand_Units"],
        rules=non_negative("Actual_Demand_Units"),
    ),
    "forecast": TableChecks(
        keys=["Forecast_Month", "Customer_ID", "Material_ID"],
        required=["Forecast_Month", "Customer_ID", "Material_ID"],
    ),
    "inventory": TableChecks(
        keys=["Snapshot_Date", "Material_ID", "Site_ID"],
        required=["Snapshot_Date", "Material_ID", "Site_ID", "On_Hand_Units", "Available_Inventory_Units"],
        rules=[
            *non_negative("On_Hand_Units", "Quality_Hold_Units", "Available_Inventory_Units", "Safety_Stock_Units"),
            not_above("Available_Inventory_Units", "On_Hand_Units"),
        ],
    ),
    "supply": TableChecks(
        keys=["Supply_ID"],
        required=[
            "Supply_ID",
            "Material_ID",
            "Site_ID",
            "Receipt_Month",
            "Planned_Supply_Units",
            "Supply_Status",
            "Supply_Type",
        ],
        rules=non_negative("Planned_Supply_Units"),
    ),
}

# Which table refers to which master, by which key.
REFERENCES = [
    ("actuals", "materials", "Material_ID"),
    ("actuals", "customers", "Customer_ID"),
    ("forecast", "materials", "Material_ID"),
    ("forecast", "customers", "Customer_ID"),
    ("inventory", "materials", "Material_ID"),
    ("supply", "materials", "Material_ID"),
]


def _references(tables: PlanningTables, field: str, history_months: int) -> DataFrame:
    """Orphan counts of a table, and for the demand history its incomplete groups, as (Check_Name, Violations).

    The table is read once. Its references are stacked and reduced to one row per reference and key, on the map side
    first; the masters, stacked likewise, then meet keys, not rows or pairs of keys.
    """
    df = getattr(tables, field)
    masters = {key: master for owner, master, key in REFERENCES if owner == field}
    zero = F.lit(0).cast("bigint")
    if field == "actuals":
        rows = df.groupBy(*masters).agg(F.count("*").alias("n"), F.count_distinct("Demand_Month").alias("months"))
        incomplete = (F.col("months") != history_months).cast("bigint")
    else:
        rows, incomplete = df.withColumn("n", F.lit(1).cast("bigint")), zero
    pairs = [
        F.struct(F.lit(key).alias("reference"), F.col(key).alias("value"), "n", (zero if i else incomplete).alias("incomplete"))
        for i, key in enumerate(masters)
    ]
    keys = rows.select(F.inline(F.array(*pairs))).groupBy("reference", "value").agg(
        F.sum("n").alias("n"), F.sum("incomplete").alias("incomplete")
    )
    known = union_all(
        getattr(tables, master).select(F.lit(key).alias("_reference"), F.col(key).alias("_value")) for key, master in masters.items()
    ).distinct()
    met = keys.join(known, (F.col("reference") == F.col("_reference")) & (F.col("value") == F.col("_value")), "left")
    orphan = F.col("_value").isNull()
    checks = [
        (f"Orphan_{key}", F.coalesce(F.sum(F.when(orphan & (F.col("reference") == key), F.col("n"))), zero)) for key in masters
    ]
    if field == "actuals":
        checks.append(("Incomplete_History", F.coalesce(F.sum("incomplete"), zero)))
    return unpivot(met, checks)


def quality_summary(tables: PlanningTables, *, history_months: int = 24) -> DataFrame:
    """Table_Name, Check_Name, Violations: one row per check, zero included.

    Each table is evaluated twice at most: for its key, missing-value and range checks, and for its references.
    """
    parts = [label(check_table(getattr(tables, field), checks), Table_Name=INPUTS[field]) for field, checks in CHECKS.items()]
    for field in dict.fromkeys(owner for owner, _, _ in REFERENCES):
        parts.append(label(_references(tables, field, history_months), Table_Name=INPUTS[field]))
    sites = multi_site_materials(tables.inventory).agg(F.count("*").alias("Violations"))
    parts.append(label(sites, Table_Name=INPUTS["inventory"], Check_Name="Multi_Site_Materials"))
    return union_all(parts)


def orphan_rows(tables: PlanningTables, key: str) -> DataFrame:
    """Table_Name and key of every row in any input table whose ``key`` the master lacks."""
    return union_all(
        label(orphans(getattr(tables, field).select(key), getattr(tables, master), key), Table_Name=INPUTS[field])
        for field, master, reference in REFERENCES
        if reference == key
    )


def uniqueness_summary(tables: PlanningTables) -> DataFrame:
    """`key_uniqueness` of every input table."""
    return union_all(
        label(key_uniqueness(getattr(tables, field), checks.keys), Table_Name=INPUTS[field]) for field, checks in CHECKS.items()
    )

