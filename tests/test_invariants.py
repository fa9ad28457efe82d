"""Relations that must hold between results on the driver's tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import drivers, projection, quality, scenarios
from shelfcast.plans import cycle
from shelfcast.sources import starschema
from shelfcast.sources.tables import materialise


AS_OF = starschema.DEFAULT_CALENDAR.as_of


@pytest.fixture(scope="module")
def t(spark, data_dir):
    return starschema.planning_tables(spark, data_dir)


@pytest.fixture(scope="module")
def projected(t):
    return materialise(scenarios.scenario_projection(cycle.analysis_of(t, as_of=AS_OF, horizon_months=6)), "projected")


@pytest.fixture(scope="module")
def profile(projected):
    return materialise(scenarios.risk_profile(projected), "profile")


def test_more_supply_never_hurts(projected):
    s1, s2, s3 = (F.col(c) for c in (scenarios.CONFIRMED, scenarios.WITH_PLANNED, scenarios.WITH_AT_RISK))
    assert projected.filter((s2 < s1) | (s3 < s2)).count() == 0


def test_last_month_equals_opening_plus_all_flow(projected):
    by_material = projected.groupBy("Material_ID").agg(
        F.max_by("Projected_Inventory", "Month").alias("last"),
        (F.max("Starting_Inventory") + F.sum(F.col("Confirmed_Supply") - F.col("Forecast_Units"))).alias("sum"),
    )
    assert by_material.filter(~F.col("last").eqNullSafe(F.col("sum"))).count() == 0


def test_one_row_per_material_and_month(t, projected):
    months = projection.in_horizon(t.forecast, "Forecast_Month", AS_OF, 6).select("Forecast_Month", "Material_ID").distinct().count()
    assert projected.count() == months == projected.select("Month", "Material_ID").distinct().count()


def test_all_months_include_the_forecast_months(t):
    forecast_only = projection.forecast_supply_balance(t.forecast, t.supply)
    everything = projection.forecast_supply_balance(t.forecast, t.supply, spine="union")
    assert forecast_only.exceptAll(everything).count() == 0
    supplied = t.supply.agg(F.sum("Planned_Supply_Units")).collect()[0][0]
    columns = sum((F.col(c) for c in projection.SUPPLY_COLUMNS), F.lit(0))
    assert everything.agg(F.sum(columns)).collect()[0][0] == supplied


def test_pareto_ends_at_the_total(profile):
    pareto = drivers.shortfall_pareto(scenarios.supply_coverage(profile), buckets=16)
    last = pareto.orderBy(F.desc("Cumulative_Shortfall_Units")).first()
    assert last.Cumulative_Shortfall_Units == last.Total_Shortfall_Units
    assert last.Cumulative_Shortfall_Pct == 100.0
    assert pareto.count() == profile.filter("Critical_Stockout_Flag = 1").count()


def test_priority_set_is_minimal(profile):
    pareto = drivers.shortfall_pareto(scenarios.supply_coverage(profile))
    chosen = drivers.pareto_priority(pareto).agg(
        F.max("Cumulative_Shortfall_Units").alias("reached"),
        F.max(F.col("Cumulative_Shortfall_Units") - F.col("Remaining_Shortfall_Units")).alias("before_last"),
        F.max("Total_Shortfall_Units").alias("total"),
    ).collect()[0]
    assert chosen.before_last < 0.8 * chosen.total <= chosen.reached


def test_status_counts_add_up(profile):
    priority = scenarios.prioritise(profile)
    assert scenarios.status_counts(priority).agg(F.sum("count")).collect()[0][0] == priority.count()


def test_orphans_and_known_rows_make_up_the_table(t):
    known = t.actuals.join(t.materials, "Material_ID", "left_semi").count()
    unknown = quality.orphans(t.actuals, t.materials, "Material_ID").count()
    assert known + unknown == t.actuals.count()


def test_dedupe_removes_the_surplus_of_exact_copies(t):
    loss = quality.dedupe_loss(t.actuals).collect()[0]
    assert loss.Rows_After == quality.dedupe_exact(t.actuals).count()
    surplus = t.actuals.groupBy(*t.actuals.columns).count().agg(F.sum(F.col("count") - 1)).collect()[0][0]
    assert loss.Rows_Removed == surplus > 0


def test_result_does_not_depend_on_partitioning(spark, t, data_dir):
    """The same rows, cut differently and with a different number of shuffle partitions."""
    expected = sorted(map(tuple, drivers.shortfall_pareto(scenarios.supply_coverage(cycle.profile_of(cycle.analysis_of(t)))).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = cycle.profile_of(cycle.analysis_of(starschema.planning_tables(spark, data_dir)))
        got = sorted(map(tuple, drivers.shortfall_pareto(scenarios.supply_coverage(again), buckets=5).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == expected


def test_all_order_lines_up_to_the_cutover_are_read(spark, t, data_dir):
    orders = spark.read.parquet(f"{data_dir}/orders.parquet").filter(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
    lines = spark.read.parquet(f"{data_dir}/lineitem.parquet").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    key = F.col("l_orderkey")
    copies = lines.filter((key % 101 == 0) & (key % 997 != 3) & (key % 991 != 4)).count()
    assert t.actuals.count() == lines.count() + copies
    assert t.supply.count() == spark.read.parquet(f"{data_dir}/lineitem.parquet").count()


def test_sites_add_up_to_the_material(spark, t, data_dir):
    stock = starschema.multi_site_inventory(spark, data_dir)
    options = {"as_of": AS_OF, "horizon_months": 6}
    pooled = projection.project_inventory(t.forecast, t.supply, stock, site_mode="pooled", **options)
    sites = projection.project_inventory(t.forecast, t.supply, stock, site_mode="by_site", **options)
    units = ["Forecast_Units", "Starting_Inventory", *projection.SUPPLY_COLUMNS, "Projected_Inventory"]
    added = sites.groupBy("Month", "Material_ID").agg(*[F.sum(c).alias(c) for c in units])
    columns = ["Month", "Material_ID", *units]
    assert pooled.select(columns).exceptAll(added.select(columns)).count() == 0
    assert added.count() == pooled.count()


def test_flags_and_counts_agree_for_any_threshold(t):
    for limit in (0, 5, F.col("Safety_Stock_Units")):
        analysis = cycle.analysis_of(t, as_of=AS_OF, horizon_months=6, threshold=limit)
        counts = scenarios.scenario_counts(cycle.profile_of(analysis, threshold=limit)).first()
        assert counts.At_Risk_Confirmed == projection.stockout_material_count(analysis).first()[0]


def test_references_evaluate_the_history_twice_at_most(t):
    from shelfcast.plans import validation

    plan = validation.quality_summary(t)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("o_orderdate") and sum("Relation" in line and "o_orderdate" in line for line in plan.split("\n")) <= 4


def test_the_report_joins_the_master_only(t):
    profile = materialise(cycle.profile_of(cycle.analysis_of(t, as_of=AS_OF, horizon_months=6)), "profile")
    plan = cycle.report_of(profile, materialise(t.materials, "materials"))._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Join " in line for line in plan.split("\n")) == 1


def test_references_join_the_masters_once(t):
    from shelfcast.plans import validation

    plan = validation._references(t, "actuals", 24)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join LeftOuter" in line]
    assert len(joins) == 1 and "reference" in joins[0]


def test_stored_demand_is_joined_once(spark, data_dir):
    import __spark_entry__ as entry_module

    t = entry_module._with_stored_demand(starschema.planning_tables(spark, data_dir))
    assert t.forecast is t.forecast
    for stored in (t.actuals, t.forecast):
        plan = stored._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "o_orderdate" not in plan
