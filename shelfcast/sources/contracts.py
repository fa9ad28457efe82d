"""Schema contracts of the planning tables, and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Table and column names of the planning data model.
MATERIAL_MASTER = "material_master_raw"
CUSTOMER_MASTER = "customer_master_raw"
DEMAND_ACTUALS = "demand_actuals_raw"
DEMAND_ACTUALS_CLEAN = "demand_actuals_clean"
DEMAND_FORECAST = "demand_forecast_raw"
INVENTORY_SNAPSHOT = "inventory_snapshot_raw"
PLANNED_SUPPLY = "planned_supply_raw"
ANALYSIS = "stockout_risk_analysis"
STOCKOUTS = "stockout_risk_powerbi"
REPORT = "stockout_risk_powerbi_final"

# What the stockout list is checked for before it is stored.
STOCKOUT_REQUIRED = [
    "Material_ID", "Site_ID", "Stockout_Status", "First_Stockout_Month", "Stockout_Units", "Unit_Price_USD", "Stockout_Value_USD",
]

MATERIAL_ATTRIBUTES = {
    "Material_Description": T.StringType(),
    "GPL_Code": T.StringType(),
    "GPL_Name": T.StringType(),
    "Primary_Site": T.StringType(),
    "Site_Name": T.StringType(),
    "Site_Region": T.StringType(),
    "Application_Segment": T.StringType(),
    "Lifecycle": T.StringType(),
    "Lead_Time_Days": T.IntegerType(),
    "Unit_Price_USD": MONEY,
}

_STOCKOUT_COLUMNS = {
    "Material_ID": T.StringType(),
    "Site_ID": T.StringType(),
    "Stockout_Status": T.StringType(),
    "First_Stockout_Month": T.DateType(),
    "Stockout_Units": T.LongType(),
    **MATERIAL_ATTRIBUTES,
    "Stockout_Value_USD": MONEY,
}

_ACTUALS_COLUMNS = {
    "Demand_Month": T.DateType(),
    "Customer_ID": T.StringType(),
    "Material_ID": T.StringType(),
    "Actual_Demand_Units": T.LongType(),
}

_COLUMNS = {
    MATERIAL_MASTER: {"Material_ID": T.StringType(), **MATERIAL_ATTRIBUTES},
    CUSTOMER_MASTER: {"Customer_ID": T.StringType()},
    DEMAND_ACTUALS: _ACTUALS_COLUMNS,
    DEMAND_ACTUALS_CLEAN: _ACTUALS_COLUMNS,
    DEMAND_FORECAST: {
        "Forecast_Month": T.DateType(),
        "Customer_ID": T.StringType(),
        "Material_ID": T.StringType(),
        "Current_Forecast_Units": T.LongType(),
        "Customer_Demand_Units": T.LongType(),
        "Prior_Cycle_Forecast_Units": T.LongType(),
    },
    INVENTORY_SNAPSHOT: {
        "Snapshot_Date": T.DateType(),
        "Material_ID": T.StringType(),
        "Site_ID": T.StringType(),
        "On_Hand_Units": T.LongType(),
        "Quality_Hold_Units": T.LongType(),
        "Available_Inventory_Units": T.LongType(),
        "Safety_Stock_Units": T.LongType(),
    },
    PLANNED_SUPPLY: {
        "Supply_ID": T.StringType(),
        "Material_ID": T.StringType(),
        "Site_ID": T.StringType(),
        "Receipt_Month": T.DateType(),
        "Planned_Supply_Units": T.LongType(),
        "Supply_Status": T.StringType(),
        "Supply_Type": T.StringType(),
    },
    ANALYSIS: {
        "Month": T.DateType(),
        "Material_ID": T.StringType(),
        "Site_ID": T.StringType(),
        "Starting_Inventory": T.LongType(),
        "Safety_Stock_Units": T.LongType(),
        "Forecast_Units": T.LongType(),
        "Confirmed_Supply": T.LongType(),
        "Planned_Supply": T.LongType(),
        "At_Risk_Supply": T.LongType(),
        "Unknown_Supply": T.LongType(),
        "Projected_Inventory": T.LongType(),
        "Stockout_Risk_Flag": T.IntegerType(),
    },
    STOCKOUTS: _STOCKOUT_COLUMNS,
    REPORT: {**_STOCKOUT_COLUMNS, "Remaining_Shortfall_Units": T.LongType()},
}

SCHEMAS: dict[str, T.StructType] = {
    table: T.StructType([T.StructField(name, kind) for name, kind in columns.items()])
    for table, columns in _COLUMNS.items()
}


class ContractError(ValueError):
    """A table does not offer the columns or types its contract names."""


def schema_problems(df: DataFrame, table: str) -> list[tuple[str, str, str, str | None]]:
    """(table, column, expected type, actual type or None) for every missing or mistyped column.

    Reads metadata only. Columns beyond the contract are allowed.
    """
    actual = {field.name: field.dataType for field in df.schema}
    return [
        (table, field.name, field.dataType.simpleString(), actual[field.name].simpleString() if field.name in actual else None)
        for field in SCHEMAS[table]
        if actual.get(field.name) != field.dataType
    ]


def schema_violations(df: DataFrame, table: str) -> DataFrame:
    """`schema_problems` as a DataFrame."""
    return df.sparkSession.createDataFrame(
        schema_problems(df, table), "Table_Name string, Column_Name string, Expected_Type string, Actual_Type string"
    )


def cast_losses(df: DataFrame, table: str) -> DataFrame:
    """What converting a table to its contract would lose, from one pass over its rows.

    ``Table_Name, Column_Name, Expected_Type, Actual_Type, Unreadable_Rows, Changed_Rows`` for each mistyped column: values
    that the expected type cannot hold, and values that it holds but that do not come back the same (a fraction or a time of day
    cut off). A table with the right types, or none of the mistyped columns, gives no rows. `enforce` with ``cast`` fails on
    the former and is silent about the latter.
    """
    wrong = [p for p in schema_problems(df, table) if p[3] is not None]
    if not wrong:
        return df.sparkSession.createDataFrame([], _LOSSES)
    counts = []
    for _, name, expected, actual in wrong:
        read = F.col(f"`{name}`").try_cast(expected)
        # A text may spell a value in many ways; it is the value that has to come back.
        counts.append(F.count_if(F.col(f"`{name}`").isNotNull() & read.isNull()).alias(f"unreadable_{name}"))
        back = F.lit(True) if actual == "string" else read.try_cast(actual).eqNullSafe(F.col(f"`{name}`"))
        counts.append(F.count_if(read.isNotNull() & ~back).alias(f"changed_{name}"))
    one = df.agg(*counts)
    rows = [
        F.struct(
            F.lit(table).alias("Table_Name"), F.lit(name).alias("Column_Name"), F.lit(expected).alias("Expected_Type"),
            F.lit(actual).alias("Actual_Type"), F.col(f"`unreadable_{name}`").alias("Unreadable_Rows"),
            F.col(f"`changed_{name}`").alias("Changed_Rows"),
        )
        for _, name, expected, actual in wrong
    ]
    return one.select(F.inline(F.array(*rows)))


_LOSSES = (
    "Table_Name string, Column_Name string, Expected_Type string, Actual_Type string, Unreadable_Rows bigint, Changed_Rows bigint"
)


def enforce(df: DataFrame, table: str, *, cast: bool = False) -> DataFrame:
    """Project ``df`` to its contract; raise `ContractError` on a mismatch.

    With ``cast`` mistyped columns are converted (a malformed value then fails the job under ANSI mode) and only
    missing columns are errors.
    """
    problems = schema_problems(df, table)
    if cast:
        problems = [problem for problem in problems if problem[3] is None]
    if problems:
        raise ContractError("; ".join(f"{t}.{c}: expected {e}, found {a or 'nothing'}" for t, c, e, a in problems))
    return df.select(*[F.col(field.name).cast(field.dataType) if cast else F.col(field.name) for field in SCHEMAS[table]])
