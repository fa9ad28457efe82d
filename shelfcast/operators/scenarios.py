"""Supply scenarios, residual risk and prioritisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import worth
from shelfcast.operators.projection import as_limit, running_inventory
from shelfcast.sources.contracts import MATERIAL_ATTRIBUTES

# Scenario column -> supply it counts on. The first scenario, confirmed supply, is part of the analysis table.
CONFIRMED = "Projected_Inventory"
WITH_PLANNED = "Projected_Inventory_With_Planned"
WITH_AT_RISK = "Projected_Inventory_With_At_Risk"
SCENARIOS: dict[str, Sequence[str]] = {
    WITH_PLANNED: ("Confirmed_Supply", "Planned_Supply"),
    WITH_AT_RISK: ("Confirmed_Supply", "Planned_Supply", "At_Risk_Supply"),
}

# Label in counts and flags -> scenario column, least supply first.
LABELS: dict[str, str] = {"Confirmed": CONFIRMED, "With_Planned": WITH_PLANNED, "With_At_Risk": WITH_AT_RISK}

CRITICAL = "Critical Stockout"
STOCKOUT = "Stockout"


def scenario_projection(analysis: DataFrame, scenarios: Mapping[str, Sequence[str]] = SCENARIOS) -> DataFrame:
    """Add one running inventory per scenario; all of them share one sort and one window pass."""
    return analysis.select("*", *[running_inventory(list(used)).alias(name) for name, used in scenarios.items()])


def scenario_counts(profile: DataFrame, scenarios: Sequence[str] = tuple(LABELS)) -> DataFrame:
    """One row: materials at risk per scenario, and how many fewer each next one leaves.

    ``scenarios`` are labels of the profile, least supply first. The differences are of counts; they equal the number of
    rescued materials as long as no supply is negative.
    """
    flags = [f"At_Risk_{label}" for label in scenarios]
    per_material = profile.filter(F.col("Material_ID").isNotNull()).groupBy("Material_ID").agg(*[F.max(f).alias(f) for f in flags])
    counts = per_material.agg(*[F.count_if(F.col(f) == 1).alias(f) for f in flags])
    return counts.select(
        "*",
        *[
            (F.col(less) - F.col(more)).alias(f"Mitigated_By_{more.removeprefix('At_Risk_').removeprefix('With_')}")
            for less, more in zip(flags, flags[1:])
        ],
    )


def residual_risk(profile: DataFrame) -> DataFrame:
    """Lowest inventory of materials and sites that run short despite planned supply."""
    return profile.filter(F.col("Worst_Projected_Inventory").isNotNull()).select(
        "Material_ID", "Site_ID", F.col("Worst_Projected_Inventory").alias("Lowest_Projected_Inventory")
    )


def risk_profile(
    projected: DataFrame,
    *,
    site_mode: str = "single",
    threshold: Column | int = 0,
    scenarios: Mapping[str, str] = LABELS,
    risk: str = WITH_PLANNED,
    rescue: str = WITH_AT_RISK,
) -> DataFrame:
    """Everything the later steps need to know about a material and site, in one aggregation.

    A month is short when its inventory is below ``threshold``, the one the stockout flags are made with. Worst and first short
    month in the scenario ``risk``, lowest inventory and largest shortage in the scenario ``rescue``, a flag for each of
    ``scenarios`` (label to column), totals over the horizon, and two flags that hold for the material as a whole. Rows are
    placed by material and site since the running inventory, so the aggregation does not shuffle. ``site_mode`` is the one the
    projection was made with.
    """
    limit = as_limit(threshold)

    def short(scenario: str) -> Column:
        return F.col(scenario) < limit

    def shortage(scenario: str) -> Column:
        return F.coalesce(F.max(F.when(short(scenario), limit - F.col(scenario))), F.lit(0)).cast("bigint")

    per_site = projected.groupBy("Material_ID", "Site_ID").agg(
        F.min(F.when(short(risk), F.col("Month"))).alias("First_Stockout_Month"),
        F.min(F.when(short(risk), F.col(risk))).alias("Worst_Projected_Inventory"),
        shortage(risk).alias("Projected_Shortfall_Units"),
        F.min(rescue).alias("Lowest_Projected_Inventory"),
        shortage(rescue).alias("Rescue_Shortfall_Units"),
        *[F.max(F.coalesce(short(column), F.lit(False)).cast("int")).alias(f"At_Risk_{label}") for label, column in scenarios.items()],
        F.sum("Forecast_Units").alias("Six_Month_Forecast"),
        F.sum("Confirmed_Supply").alias("Confirmed_Supply"),
        F.sum("Planned_Supply").alias("Planned_Supply"),
        F.sum("At_Risk_Supply").alias("At_Risk_Supply"),
    )
    # A missing material matches nothing, so it cannot be critical.
    flags = {
        "Critical_Stockout_Flag": F.when((F.col("Rescue_Shortfall_Units") > 0) & F.col("Material_ID").isNotNull(), 1).otherwise(0),
        "Material_At_Risk": F.col("Worst_Projected_Inventory").isNotNull(),
    }
    if site_mode != "by_site":
        return per_site.withColumns(flags)
    # A material is critical at all its sites when it is at one. The flags are reduced to one row per material before
    # they return to the sites; a window would gather all sites of a material in one task.
    flagged = per_site.withColumns(flags)
    per_material = flagged.groupBy(F.col("Material_ID").alias("_material")).agg(*[F.max(name).alias(name) for name in flags])
    return flagged.drop(*flags).join(per_material, F.col("Material_ID").eqNullSafe(F.col("_material"))).drop("_material")


def prioritise(profile: DataFrame, *, shortages: bool = False) -> DataFrame:
    """Materials and sites short despite planned supply, critical when at-risk supply does not help either.

    ``shortages`` adds the shortage in units, and what of it remains after all supply: of critical materials the shortage in
    the rescuing scenario, of others 0.
    """
    remaining = F.when(F.col("Critical_Stockout_Flag") == 1, F.col("Rescue_Shortfall_Units")).otherwise(0)
    more = ["Projected_Shortfall_Units", remaining.cast("bigint").alias("Remaining_Shortfall_Units")] if shortages else []
    return profile.filter(F.col("Worst_Projected_Inventory").isNotNull()).select(
        "Material_ID",
        "Site_ID",
        "First_Stockout_Month",
        "Worst_Projected_Inventory",
        "Critical_Stockout_Flag",
        F.when(F.col("Critical_Stockout_Flag") == 1, CRITICAL).otherwise(STOCKOUT).alias("Stockout_Status"),
        *more,
    )


def severity(priority: DataFrame) -> DataFrame:
    """The shortage in units, as a positive number; with `prioritise`'s shortages also what remains of it."""
    known = "Projected_Shortfall_Units" in priority.columns
    return priority.select(
        "Material_ID",
        "Site_ID",
        "Stockout_Status",
        "First_Stockout_Month",
        *(
            ["Projected_Shortfall_Units", "Remaining_Shortfall_Units"]
            if known
            else [F.abs("Worst_Projected_Inventory").alias("Projected_Shortfall_Units")]
        ),
    )


def enrich_and_value(shortages: DataFrame, materials: DataFrame) -> DataFrame:
    """Add the material attributes and the shortage in money. Materials the master lacks stay, without a value.

    A remaining shortage is carried along, as the last column: the list is then the reporting table.
    """
    carried = [c for c in shortages.columns if c == "Remaining_Shortfall_Units"]
    return shortages.join(materials.select("Material_ID", *MATERIAL_ATTRIBUTES), "Material_ID", "left").select(
        "Material_ID",
        "Site_ID",
        "Stockout_Status",
        "First_Stockout_Month",
        F.col("Projected_Shortfall_Units").alias("Stockout_Units"),
        *MATERIAL_ATTRIBUTES,
        worth(F.col("Projected_Shortfall_Units"), F.col("Unit_Price_USD")).alias("Stockout_Value_USD"),
        *carried,
    )


def status_counts(final: DataFrame) -> DataFrame:
    """Rows per stockout status."""
    return final.groupBy("Stockout_Status").agg(F.count("*").alias("count"))


def supply_coverage(profile: DataFrame, final: DataFrame | None = None) -> DataFrame:
    """Forecast, supply and remaining shortage of critical materials over the horizon, counting all known supply.

    The critical materials are those of the profile, or those a stored stockout list ``final`` names.
    """
    if final is None:
        critical = profile.filter((F.col("Critical_Stockout_Flag") == 1) & F.col("Material_At_Risk"))
    else:
        named = final.filter(F.col("Stockout_Status") == CRITICAL).select("Material_ID")
        critical = profile.join(named, "Material_ID", "left_semi")
    return critical.select(
        "Material_ID",
        "Site_ID",
        "Lowest_Projected_Inventory",
        "Six_Month_Forecast",
        "Confirmed_Supply",
        "Planned_Supply",
        "At_Risk_Supply",
        F.col("Rescue_Shortfall_Units").alias("Remaining_Shortfall_Units"),
    )


def ranked(df: DataFrame, by: str, *, ascending: bool = False, ties: Sequence[str] = ("Material_ID", "Site_ID"), top: int | None = None) -> DataFrame:
    """Order rows for presentation, ties broken by key. ``top`` keeps the first rows without a full sort.

    The operators above leave their rows unordered: a stored table does not keep an order. `with_rank` makes the order a
    column.
    """
    ordered = df.orderBy(F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by), *ties)
    return ordered if top is None else ordered.limit(top)
