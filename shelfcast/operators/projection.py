"""Monthly flows and the running inventory projection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.sources.tables import materialise

# Supply status as stored -> column it is summed into. None is the missing status.
SUPPLY_COLUMNS: dict[str, str | None] = {
    "Confirmed_Supply": "Confirmed",
    "Planned_Supply": "Planned",
    "At_Risk_Supply": "At Risk",
    "Unknown_Supply": None,
}

SPINES = ("forecast", "union")
SITE_MODES = ("single", "pooled", "by_site")


def forecast_by_month(forecast: DataFrame) -> DataFrame:
    """Customer forecasts summed to material and month."""
    return forecast.groupBy(F.col("Forecast_Month").alias("Month"), "Material_ID").agg(
        F.sum("Current_Forecast_Units").alias("Forecast_Units")
    )


def in_horizon(df: DataFrame, month: str, as_of: dt.date | None, horizon_months: int | None) -> DataFrame:
    """Rows of the months after ``as_of``: all of them, or the first ``horizon_months``."""
    if as_of is None:
        return df
    start = F.trunc(F.add_months(F.lit(as_of), 1), "month")
    later = df.filter(F.col(month) >= start)
    return later if horizon_months is None else later.filter(F.col(month) < F.add_months(start, horizon_months))


def _units_with_status(status: str | None) -> Column:
    matches = F.col("Supply_Status").isNull() if status is None else F.col("Supply_Status") == status
    return F.when(matches, F.col("Planned_Supply_Units")).otherwise(0)


def supply_by_month(supply: DataFrame) -> DataFrame:
    """Planned receipts summed to material and month, one column per status.

    A status outside the known ones, other letter case included, counts nowhere.
    """
    return supply.groupBy(F.col("Receipt_Month").alias("Month"), "Material_ID").agg(
        *[F.sum(_units_with_status(status)).alias(column) for column, status in SUPPLY_COLUMNS.items()]
    )


def forecast_supply_balance(forecast: DataFrame, supply: DataFrame, *, spine: str = "forecast") -> DataFrame:
    """Forecast and supply per material and month.

    ``spine="forecast"`` keeps the months that have a forecast, so supply of other months is left out (`unmatched_supply`
    counts it); ``spine="union"`` keeps every month with a forecast or a receipt, receipts without month or material
    included, in rows of their own.

    Both inputs are stacked and summed once. That needs one shuffle of partially summed rows, where summing both
    and joining the sums needs two shuffles and two sorts.
    """
    if spine not in SPINES:
        raise ValueError(f"spine must be one of {SPINES}, not {spine!r}")
    demand = forecast.select(
        F.col("Forecast_Month").alias("Month"), "Material_ID", F.col("Current_Forecast_Units").alias("Forecast_Units")
    )
    receipts = supply.select(F.col("Receipt_Month").alias("Month"), "Material_ID", *_by_status())
    return _balanced(demand, receipts, ["Material_ID"], spine)


def _by_status() -> list[Column]:
    return [_units_with_status(status).alias(column) for column, status in SUPPLY_COLUMNS.items()]


def _balanced(demand: DataFrame, receipts: DataFrame, keys: list[str], spine: str) -> DataFrame:
    """Stack forecast and receipts and sum them per month and ``keys``, of which the first is the material."""
    # A receipt that misses a key matches nothing in a join, so it must not meet the forecast's missing keys here either.
    keyed = F.col("Month").isNotNull() & F.col(keys[0]).isNotNull()
    if spine == "forecast":
        receipts = receipts.filter(keyed)
    stacked = demand.select("*", F.lit(1).alias("forecast_row"), F.lit(False).alias("apart")).unionByName(
        receipts.select("*", F.lit(0).alias("forecast_row"), (~keyed).alias("apart")), allowMissingColumns=True
    )
    summed = stacked.groupBy("Month", *keys, "apart").agg(
        F.max("forecast_row").alias("has_forecast"),
        F.sum("Forecast_Units").alias("Forecast_Units"),
        *[F.coalesce(F.sum(column), F.lit(0)).alias(column) for column in SUPPLY_COLUMNS],
    )
    if spine == "forecast":
        return summed.filter(F.col("has_forecast") == 1).drop("has_forecast", "apart")
    units = F.when(F.col("has_forecast") == 1, F.col("Forecast_Units")).otherwise(0)
    return summed.withColumn("Forecast_Units", units).drop("has_forecast", "apart")


def unmatched_supply(forecast: DataFrame, supply: DataFrame) -> DataFrame:
    """What ``spine="forecast"`` leaves out: receipts and units without month or material, and in months without forecast."""
    keyed = F.col("Receipt_Month").isNotNull() & F.col("Material_ID").isNotNull()
    monthly = supply.groupBy("Receipt_Month", "Material_ID").agg(
        F.count("*").alias("n"), F.sum("Planned_Supply_Units").alias("units")
    )
    months = forecast.select(F.col("Forecast_Month").alias("Receipt_Month"), "Material_ID").distinct()
    left = monthly.join(months, ["Receipt_Month", "Material_ID"], "left_anti")

    def total(condition: Column, column: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))

    return left.agg(
        total(~keyed, "n").alias("Keyless_Receipts"),
        total(~keyed, "units").alias("Keyless_Units"),
        total(keyed, "n").alias("Unplanned_Month_Receipts"),
        total(keyed, "units").alias("Unplanned_Month_Units"),
    )


STOCK_KEYS = ["Material_ID", "Site_ID"]
STOCK_UNITS = ["Available_Inventory_Units", "Safety_Stock_Units"]
OPENING = ["Starting_Inventory", "Safety_Stock_Units"]


def latest_snapshot(inventory: DataFrame, as_of: dt.date) -> DataFrame:
    """The last stock count of each material and site on or before ``as_of``: one row of stock for each, or several if they
    were counted on the same day.

    Sites are counted on different days; a site that was not counted on the very last one keeps its last count.
    """
    known = inventory.filter((F.col("Snapshot_Date") <= F.lit(as_of)) & F.col("Material_ID").isNotNull())
    units = F.struct(*[F.max(c).alias(c) for c in STOCK_UNITS], F.count("*").alias("n"))
    per_day = known.groupBy(*STOCK_KEYS, "Snapshot_Date").agg(units.alias("count"))
    last = per_day.groupBy(*STOCK_KEYS).agg(F.max_by("count", "Snapshot_Date").alias("last"))
    return last.select(*STOCK_KEYS, *[F.col(f"last.{c}").alias(c) for c in STOCK_UNITS], F.col("last.n").alias("n"))


def _one_stock_row(stock: DataFrame, keys: list[str], *, grouped: bool = False) -> DataFrame:
    """One row per key, or a failing job: a second row would count the monthly flow twice. ``grouped`` rows are one per key
    already, and only their ``n`` is checked."""
    fields = [c for c in (*STOCK_KEYS, *STOCK_UNITS) if c not in keys]
    problem = F.concat(F.lit("several inventory rows for "), F.concat_ws("/", *keys))
    rows = stock if grouped else stock.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.max(c).alias(c) for c in fields])
    return rows.select(*keys, *[F.when(F.col("n") == 1, F.col(c)).otherwise(F.raise_error(problem)).alias(c) for c in fields])


def opening_stock(
    inventory: DataFrame, *, as_of: dt.date | None = None, site_mode: str = "single", pooled_site: str = "ALL"
) -> DataFrame:
    """Opening inventory as Material_ID, Site_ID, Starting_Inventory, Safety_Stock_Units.

    With ``as_of`` the last count of each material and site up to that day, else all rows. ``single`` expects one row per
    material and fails otherwise; ``pooled`` adds up the sites of a material and names the site ``pooled_site`` when there
    are several; ``by_site`` keeps one row per material and site.
    """
    if site_mode not in SITE_MODES:
        raise ValueError(f"site_mode must be one of {SITE_MODES}, not {site_mode!r}")
    if as_of is None:
        rows = inventory.filter(F.col("Material_ID").isNotNull()).select(*STOCK_KEYS, *STOCK_UNITS, F.lit(1).alias("n"))
    else:
        rows = latest_snapshot(inventory, as_of)
    if site_mode == "single":
        stock = _one_stock_row(rows, ["Material_ID"])
    else:
        stock = _one_stock_row(rows, STOCK_KEYS, grouped=as_of is not None)
    if site_mode == "pooled":
        stock = stock.groupBy("Material_ID").agg(
            F.when(F.count("*") > 1, pooled_site).otherwise(F.max("Site_ID")).alias("Site_ID"),
            *[F.sum(c).alias(c) for c in STOCK_UNITS],
        )
    return stock.select(*STOCK_KEYS, *[F.col(units).alias(c) for units, c in zip(STOCK_UNITS, OPENING)])


def site_shares(stock: DataFrame, supply: DataFrame) -> DataFrame:
    """The sites of every stocked material, and their places in its forecast: Material_ID, Site_ID, Starting_Inventory,
    Safety_Stock_Units, From_Share, To_Share, All_Shares, First_Site.

    Sites that only receive supply have an opening stock of 0. A site's share is its opening stock (none if negative); without
    any stock the first site by Site_ID has it all. Shares are cumulative along Site_ID, so that what is split by them adds up.
    A window holds the sites of one material. ``stock`` has one row per material and site.

    Stock and receiving sites are placed alike by their aggregations, so joining them neither shuffles nor keeps all sites in
    hash tables once more.
    """
    received = supply.filter(F.col("Site_ID").isNotNull() & F.col("Material_ID").isNotNull()).select(*STOCK_KEYS).distinct()
    sites = stock.withColumn("stocked", F.lit(1)).join(received, STOCK_KEYS, "full").fillna(0, [*OPENING, "stocked"])
    ordered = Window.partitionBy("Material_ID").orderBy(F.asc_nulls_first("Site_ID"))
    whole = Window.partitionBy("Material_ID")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stock_share = F.greatest("Starting_Inventory", F.lit(0))
    share = F.when(F.sum(stock_share).over(whole) > 0, stock_share).otherwise((F.row_number().over(ordered) == 1).cast("bigint"))
    return (
        sites.withColumn("share", share)
        .withColumn("has_stock", F.max("stocked").over(whole))
        .withColumn("First_Site", F.first(F.struct("Site_ID")).over(so_far))
        .withColumn("To_Share", F.sum("share").over(so_far))
        .withColumn("All_Shares", F.sum("share").over(whole))
        .filter(F.col("has_stock") == 1)
        .select(*STOCK_KEYS, "Starting_Inventory", "Safety_Stock_Units", (F.col("To_Share") - F.col("share")).alias("From_Share"),
                "To_Share", "All_Shares", "First_Site")
    )


def site_balance(forecast: DataFrame, supply: DataFrame, stock: DataFrame, *, spine: str = "forecast") -> DataFrame:
    """Opening stock, forecast and supply per material, site and month.

    A material's forecast of a month is split among its sites by their shares, see `site_shares`; receipts count at their own
    site, those without site at the first one. So sites add up to the material. A material without any stock row keeps one row
    per month, without site and opening stock.

    The shares are evaluated and stored here and now: forecast, receipts and opening stock read them, and no task sorts the
    sites for several of them at once. A month of a site has one row of forecast, which brings the opening stock along, and one
    of receipts: they are joined, as summing both again would hold all of them in two hash tables of one task.
    """
    if spine not in SPINES:
        raise ValueError(f"spine must be one of {SPINES}, not {spine!r}")
    sites = materialise(site_shares(stock, supply), "site-shares")
    monthly = forecast_by_month(forecast)
    units = F.col("Forecast_Units")
    to_here = F.expr("(Forecast_Units * To_Share) div All_Shares")
    before = F.expr("(Forecast_Units * From_Share) div All_Shares")
    split = monthly.join(sites, "Material_ID", "left").select(
        "Month",
        *STOCK_KEYS,
        F.when(F.col("All_Shares").isNull(), units).otherwise(to_here - before).alias("Forecast_Units"),
        *OPENING,
        F.lit(1).alias("has_forecast"),
    )
    first = sites.where(F.col("Site_ID").eqNullSafe(F.col("First_Site.Site_ID"))).select(
        F.col("Material_ID").alias("_material"), F.col("First_Site").alias("_first")
    )
    if spine == "forecast":
        supply = supply.filter(F.col("Receipt_Month").isNotNull() & F.col("Material_ID").isNotNull())
    receipts = (
        supply.groupBy(F.col("Receipt_Month").alias("Month"), *STOCK_KEYS)
        .agg(*[F.sum(_units_with_status(status)).alias(column) for column, status in SUPPLY_COLUMNS.items()])
        .join(first, F.col("Material_ID") == F.col("_material"), "left")
        .withColumn(
            "Site_ID",
            F.when(F.col("_material").isNotNull(), F.coalesce(F.col("Site_ID"), F.col("_first.Site_ID"))),
        )
        .groupBy("Month", *STOCK_KEYS)
        .agg(*[F.sum(column).alias(column) for column in SUPPLY_COLUMNS])
    )
    if spine == "union":  # months without forecast get their opening stock from the site
        receipts = _at_site(receipts, sites.select(*STOCK_KEYS, *OPENING), STOCK_KEYS, "left")
        receipts = receipts.withColumnsRenamed({c: f"_opening_{c}" for c in OPENING})
    # A receipt that misses month or material matches no forecast.
    flow = _at_site(split, receipts, ["Month", *STOCK_KEYS], "left" if spine == "forecast" else "full")
    flow = flow.fillna(0, list(SUPPLY_COLUMNS))
    if spine == "union":
        flow = flow.withColumns(
            {c: F.when(F.col("has_forecast") == 1, F.col(c)).otherwise(F.col(f"_opening_{c}")) for c in OPENING}
            | {"Forecast_Units": F.when(F.col("has_forecast") == 1, units).otherwise(0)}
        )
    return flow.select("Month", *STOCK_KEYS, "Forecast_Units", *SUPPLY_COLUMNS, *OPENING)


def _at_site(df: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on ``keys``, of which a missing site, and no other, equals a missing site."""
    right = other.withColumnsRenamed({key: f"_{key}" for key in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) if k == "Site_ID" else F.col(k) == F.col(f"_{k}") for k in keys]
    joined = df.join(right, same, how)
    if how == "full":
        joined = joined.withColumns({k: F.coalesce(k, f"_{k}") for k in keys})
    return joined.drop(*[f"_{k}" for k in keys])


def running_inventory(supply_columns: list[str] | tuple[str, ...]) -> Column:
    """Opening stock plus the running sum of the given supply minus the forecast. Shortages carry forward.

    A group of this window has one row per month.
    """
    to_date = (
        Window.partitionBy("Material_ID", "Site_ID").orderBy("Month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    received = F.col(supply_columns[0])
    for column in supply_columns[1:]:
        received = received + F.col(column)
    return F.col("Starting_Inventory") + F.sum(received - F.col("Forecast_Units")).over(to_date)


def project_inventory(
    forecast: DataFrame,
    supply: DataFrame,
    inventory: DataFrame,
    *,
    as_of: dt.date | None = None,
    horizon_months: int | None = None,
    site_mode: str = "single",
    spine: str = "forecast",
) -> DataFrame:
    """Running inventory per material and month with confirmed supply only.

    With ``as_of`` the last stock counts up to that day open the first month after it, and earlier months are left out;
    ``horizon_months`` limits how many follow. A material without stock row gets a NULL projection.
    """
    stock = opening_stock(inventory, as_of=as_of, site_mode=site_mode)
    forecast = in_horizon(forecast, "Forecast_Month", as_of, horizon_months)
    dated = in_horizon(supply, "Receipt_Month", as_of, horizon_months)
    if spine == "union" and as_of is not None:  # receipts without month are no earlier ones
        dated = dated.unionByName(supply.filter(F.col("Receipt_Month").isNull()))
    if site_mode == "by_site":
        flow = site_balance(forecast, dated, stock, spine=spine)
    else:
        flow = forecast_supply_balance(forecast, dated, spine=spine).join(stock, "Material_ID", "left")
    return flow.select(
        "Month",
        "Material_ID",
        "Site_ID",
        "Starting_Inventory",
        "Safety_Stock_Units",
        "Forecast_Units",
        *SUPPLY_COLUMNS,
        running_inventory(["Confirmed_Supply"]).alias("Projected_Inventory"),
    )


def as_limit(threshold: Column | int) -> Column:
    return threshold if isinstance(threshold, Column) else F.lit(threshold)


def flag_stockouts(projection: DataFrame, *, threshold: Column | int = 0) -> DataFrame:
    """Mark months whose projection falls below ``threshold``; an unknown projection is not marked."""
    return projection.withColumn(
        "Stockout_Risk_Flag", F.when(F.col("Projected_Inventory") < as_limit(threshold), 1).otherwise(0)
    )


def stockout_risk_analysis(
    forecast: DataFrame,
    supply: DataFrame,
    inventory: DataFrame,
    *,
    as_of: dt.date | None = None,
    horizon_months: int | None = None,
    site_mode: str = "single",
    spine: str = "forecast",
    threshold: Column | int = 0,
) -> DataFrame:
    """The analytical table: `project_inventory` with the stockout flag."""
    projection = project_inventory(
        forecast, supply, inventory, as_of=as_of, horizon_months=horizon_months, site_mode=site_mode, spine=spine
    )
    return flag_stockouts(projection, threshold=threshold)


def stockout_material_count(analysis: DataFrame) -> DataFrame:
    """Materials that are flagged in at least one month."""
    return analysis.filter(F.col("Stockout_Risk_Flag") == 1).agg(
        F.count_distinct("Material_ID").alias("Stockout_Risk_Materials")
    )


def unknown_inventory(analysis: DataFrame) -> DataFrame:
    """Materials and rows the flags are silent about because no opening stock is known."""
    return analysis.filter(F.col("Starting_Inventory").isNull()).agg(
        F.count_distinct("Material_ID").alias("Unknown_Inventory_Materials"), F.count("*").alias("Unknown_Inventory_Rows")
    )


def first_stockout(analysis: DataFrame) -> DataFrame:
    """First flagged month per material."""
    return (
        analysis.filter(F.col("Stockout_Risk_Flag") == 1)
        .groupBy("Material_ID")
        .agg(F.min("Month").alias("First_Stockout_Month"))
    )


def stockout_timing(first: DataFrame) -> DataFrame:
    """How many materials run short for the first time in each month."""
    return first.groupBy("First_Stockout_Month").agg(F.count("*").alias("count")).orderBy("First_Stockout_Month")
