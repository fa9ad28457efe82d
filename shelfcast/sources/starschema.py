"""Derives the planning tables from an order-management star schema.

Lines of orders after the cutover stand for the demand forecast, lines of earlier orders for demand history, all
shipments for planned supply and the part catalog for the material master and the stock. All rows are read. Some keys of
the facts are broken or blanked, and some values negated or blanked, so that every quality check has something to find.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfcast.sources.contracts import MONEY, ContractError
from shelfcast.sources.tables import PlanningTables

SITES = 25
LOST = 10**8  # added to a key, it is one no master has


@dataclass(frozen=True)
class Calendar:
    """The day between history and horizon, and what the queries ask for."""

    as_of: dt.date = dt.date(2000, 12, 31)
    history_months: int = 72
    horizon_months: int = 6

    @property
    def horizon_start(self) -> dt.date:
        return self.as_of + dt.timedelta(days=1)

    def in_history(self, moment: Column) -> Column:
        # A plain bound on the stored column, so that the Parquet scan can skip row groups.
        return moment < F.lit(self.horizon_start).cast("timestamp_ntz")

    def in_horizon(self, moment: Column) -> Column:
        return moment >= F.lit(self.horizon_start).cast("timestamp_ntz")


DEFAULT_CALENDAR = Calendar()


# The star schema.
STAR_SCHEMA = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def _read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the star schema; a missing or mistyped column is an error instead of a column of NULLs."""
    df = spark.read.parquet(f"{root}/{table}.parquet")
    expected = StructType.fromDDL(STAR_SCHEMA[table])
    actual = {field.name: field.dataType for field in df.schema}
    wrong = [field.name for field in expected if actual.get(field.name) != field.dataType]
    if wrong:
        raise ContractError(f"{table}: missing or mistyped {', '.join(wrong)}")
    return df.select(*expected.names)


def _padded(prefix: str, number: Column, width: int) -> Column:
    digits = number.cast("string")
    # Zero-fill without lpad, which would cut numbers longer than the width and merge different keys.
    return F.concat(F.lit(prefix), F.repeat(F.lit("0"), F.lit(width) - F.length(digits)), digits)


def _broken(key: Column, lost: Column, blank: Column) -> Column:
    """The key, with one that no master has where ``lost``, and none where ``blank``."""
    return F.when(~blank, F.when(lost, key + LOST).otherwise(key))


def _material(part_key: Column) -> Column:
    return _padded("MAT-", part_key, 6)


def _customer(customer_key: Column) -> Column:
    return _padded("C", customer_key, 6)


def _site(key: Column, sites: int = SITES) -> Column:
    return _padded("S", key % sites, 2)


def _month(moment: Column) -> Column:
    return F.date_trunc("month", moment).cast("date")


def material_master(spark: SparkSession, root: str) -> DataFrame:
    part = _read(spark, root, "part")
    nation = _read(spark, root, "nation")
    region = _read(spark, root, "region")
    return (
        part.join(nation, F.col("n_nationkey") == F.col("p_partkey") % SITES)
        .join(region, F.col("r_regionkey") == F.col("n_regionkey"))
        .select(
            _material(F.col("p_partkey")).alias("Material_ID"),
            F.col("p_name").alias("Material_Description"),
            F.col("p_brand").alias("GPL_Code"),
            F.col("p_type").alias("GPL_Name"),
            _site(F.col("p_partkey")).alias("Primary_Site"),
            F.col("n_name").alias("Site_Name"),
            F.col("r_name").alias("Site_Region"),
            F.col("p_type").alias("Application_Segment"),
            F.when(F.col("p_size") <= 10, "New").when(F.col("p_size") <= 40, "Active").otherwise("Phase-Out").alias("Lifecycle"),
            (F.col("p_size") * 2 + 10).cast("int").alias("Lead_Time_Days"),
            F.col("p_retailprice").cast(MONEY).alias("Unit_Price_USD"),
        )
    )


def customer_master(spark: SparkSession, root: str) -> DataFrame:
    return (
        _read(spark, root, "customer")
        .select(
            _customer(F.col("c_custkey")).alias("Customer_ID"),
            F.col("c_name").alias("Customer_Name"),
            F.col("c_mktsegment").alias("Segment"),
        )
    )


def demand_actuals(spark: SparkSession, root: str, calendar: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    orders = _read(spark, root, "orders").filter(calendar.in_history(F.col("o_orderdate")))
    lines = _read(spark, root, "lineitem")
    order = F.col("l_orderkey")
    blank, negative = order % 997 == 3, order % 991 == 4
    units = F.col("l_quantity").cast("bigint")
    # Some lines appear twice. Repeating them after the join reads and joins the lines once.
    copies = F.when((order % 101 == 0) & ~blank & ~negative, 2).otherwise(1)
    return lines.join(orders, order == F.col("o_orderkey")).select(
        F.when(order % 1031 != 9, _month(F.col("o_orderdate"))).alias("Demand_Month"),
        _customer(_broken(F.col("o_custkey"), order % 307 == 5, order % 1009 == 5)).alias("Customer_ID"),
        _material(_broken(F.col("l_partkey"), order % 211 == 7, order % 1013 == 6)).alias("Material_ID"),
        F.explode(F.array_repeat(F.when(blank, None).when(negative, -units).otherwise(units), copies)).alias("Actual_Demand_Units"),
    )


def demand_forecast(spark: SparkSession, root: str, calendar: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    orders = _read(spark, root, "orders").filter(calendar.in_horizon(F.col("o_orderdate")))
    lines = _read(spark, root, "lineitem")
    order, quantity = F.col("l_orderkey"), F.col("l_quantity")
    customer = _broken(F.col("o_custkey"), order % 307 == 5, order % 1009 == 5)
    part = _broken(F.col("l_partkey"), order % 211 == 7, order % 1013 == 6)
    return (
        lines.join(orders, order == F.col("o_orderkey"))
        .groupBy(_month(F.col("o_orderdate")).alias("Forecast_Month"), customer.alias("o_custkey"), part.alias("l_partkey"))
        .agg(
            F.sum(quantity).cast("bigint").alias("Current_Forecast_Units"),
            F.sum(quantity - order % 3).cast("bigint").alias("Customer_Demand_Units"),
            F.sum(quantity - 2 + order % 5).cast("bigint").alias("Prior_Cycle_Forecast_Units"),
        )
        .select(
            "Forecast_Month",
            _customer(F.col("o_custkey")).alias("Customer_ID"),
            _material(F.col("l_partkey")).alias("Material_ID"),
            "Current_Forecast_Units",
            "Customer_Demand_Units",
            "Prior_Cycle_Forecast_Units",
        )
    )


def inventory_snapshot(spark: SparkSession, root: str, calendar: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """One stock row per material, at its own site; some are of materials the master lacks, so theirs have none."""
    key = F.col("p_partkey")
    on_hand = (key * 37) % 101
    hold = F.when(key % 10 == 0, 5).otherwise(0).cast("bigint")
    return (
        _read(spark, root, "part").select(
            F.lit(calendar.as_of).alias("Snapshot_Date"),
            _material(_broken(key, key % 151 == 11, F.lit(False))).alias("Material_ID"),
            F.when(key % 157 != 13, _site(key)).alias("Site_ID"),
            on_hand.alias("On_Hand_Units"),
            hold.alias("Quality_Hold_Units"),
            (on_hand - hold).alias("Available_Inventory_Units"),
            F.col("p_size").cast("bigint").alias("Safety_Stock_Units"),
        )
    )


def multi_site_inventory(spark: SparkSession, root: str, calendar: Calendar = DEFAULT_CALENDAR) -> DataFrame:
    """Stock of one material at up to five sites on two dates: what its suppliers had delivered by then."""
    dates = [calendar.as_of.replace(day=1), calendar.as_of]
    lines = _read(spark, root, "lineitem").filter(F.col("l_shipdate") <= F.lit(calendar.as_of).cast("timestamp_ntz"))
    delivered = [
        F.sum(F.when(F.col("l_shipdate") <= F.lit(date).cast("timestamp_ntz"), F.col("l_quantity"))).cast("bigint") for date in dates
    ]
    stock = F.col("stock.units") % 41
    return (
        lines.groupBy("l_partkey", (F.col("l_suppkey") % 5).alias("site"))
        .agg(*[units.alias(f"units_{i}") for i, units in enumerate(delivered)])
        .select(
            _material(F.col("l_partkey")).alias("Material_ID"),
            _site(F.col("site"), 5).alias("Site_ID"),
            F.explode(
                F.array(*[F.struct(F.lit(date).alias("on"), F.col(f"units_{i}").alias("units")) for i, date in enumerate(dates)])
            ).alias("stock"),
        )
        # the last site is not counted on the last day
        .filter(F.col("stock.units").isNotNull() & ((F.col("Site_ID") != "S04") | (F.col("stock.on") != F.lit(dates[-1]))))
        .select(
            F.col("stock.on").alias("Snapshot_Date"),
            "Material_ID",
            "Site_ID",
            stock.alias("On_Hand_Units"),
            F.lit(0).cast("bigint").alias("Quality_Hold_Units"),
            stock.alias("Available_Inventory_Units"),
            F.lit(10).cast("bigint").alias("Safety_Stock_Units"),
        )
    )


def planned_supply(spark: SparkSession, root: str) -> DataFrame:
    order = F.col("l_orderkey")
    status = F.when(F.col("l_returnflag") == "N", "Confirmed").when(F.col("l_returnflag") == "A", "Planned").otherwise("At Risk")
    return (
        _read(spark, root, "lineitem").select(
            F.concat(F.lit("SUP-"), order.cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("Supply_ID"),
            _material(_broken(F.col("l_partkey"), order % 223 == 3, order % 1021 == 8)).alias("Material_ID"),
            F.when(order % 1033 != 1, _site(F.col("l_partkey"))).alias("Site_ID"),
            F.when(order % 1039 != 2, _month(F.col("l_shipdate"))).alias("Receipt_Month"),
            F.col("l_quantity").cast("bigint").alias("Planned_Supply_Units"),
            F.when(order % 23 != 0, status).alias("Supply_Status"),
            F.when(order % 31 != 0, F.when(F.col("l_linestatus") == "O", "Production").otherwise("Purchase")).alias("Supply_Type"),
        )
    )


def planning_tables(spark: SparkSession, root: str, calendar: Calendar = DEFAULT_CALENDAR) -> PlanningTables:
    build = {
        "materials": lambda: material_master(spark, root),
        "customers": lambda: customer_master(spark, root),
        "actuals": lambda: demand_actuals(spark, root, calendar),
        "forecast": lambda: demand_forecast(spark, root, calendar),
        "inventory": lambda: inventory_snapshot(spark, root, calendar),
        "supply": lambda: planned_supply(spark, root),
    }
    return PlanningTables(lambda field: build[field]())
