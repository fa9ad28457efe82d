"""Aggregates behind the planning dashboard."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import percent
from shelfcast.operators.scenarios import CRITICAL
from shelfcast.sources.contracts import MONEY


def _per_material(report: DataFrame, *keys: str) -> DataFrame:
    """One row per material (within ``keys``), so that counting rows counts materials without another distinct."""
    return report.groupBy("Material_ID", *keys).agg(
        F.max((F.col("Stockout_Status") == CRITICAL).cast("int")).alias("critical"),
        F.sum("Stockout_Units").alias("units"),
        F.sum("Stockout_Value_USD").alias("value"),
        F.sum("Remaining_Shortfall_Units").alias("remaining"),
    )


def kpi_summary(materials: DataFrame, report: DataFrame) -> DataFrame:
    """One row: portfolio size, materials at risk and critical, units short and money at stake."""
    portfolio = materials.agg(F.count_distinct("Material_ID"))
    known = F.col("Material_ID").isNotNull()
    return (
        _per_material(report)
        .agg(
            F.count_if(known).alias("Materials_At_Risk"),
            F.count_if(known & (F.col("critical") == 1)).alias("Critical_Materials"),
            F.coalesce(F.sum("remaining"), F.lit(0)).alias("Critical_Gap_Units"),
            F.coalesce(F.sum("value"), F.lit(0)).cast(MONEY).alias("Exposure_USD"),
        )
        .select(portfolio.scalar().alias("Total_Materials"), "*")
    )


def plant_exposure(report: DataFrame) -> DataFrame:
    """Materials, units and money at stake per site, with the site's share of all money at stake.

    Reads ``report`` twice, for the sites and for the total: hand in the stored table.
    """
    whole = report.agg(F.sum("Stockout_Value_USD")).scalar()
    known = F.col("Material_ID").isNotNull()
    return (
        _per_material(report, "Site_ID")
        .groupBy("Site_ID")
        .agg(
            F.count_if(known).alias("Materials"),
            F.count_if(known & (F.col("critical") == 1)).alias("Critical_Materials"),
            F.sum("units").alias("Stockout_Units"),
            F.sum("value").cast(MONEY).alias("Stockout_Value_USD"),
        )
        .withColumn("Value_Share_Pct", percent(F.col("Stockout_Value_USD").cast("double"), whole.cast("double")))
    )


def recovery_timing(report: DataFrame, as_of: dt.date) -> DataFrame:
    """The last day to order so that the lead time ends by the first month short; unknown without a lead time."""
    recovery_by = F.date_sub("First_Stockout_Month", F.col("Lead_Time_Days"))
    days_left = F.datediff(recovery_by, F.lit(as_of))
    return report.select(
        "Material_ID",
        "Site_ID",
        "Stockout_Status",
        "First_Stockout_Month",
        "Lead_Time_Days",
        recovery_by.alias("Recovery_By"),
        days_left.alias("Days_To_Act"),
        (days_left < 0).alias("Overdue"),
    )
