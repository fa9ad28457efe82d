
from __future__ import annotations

import datetime as dt
import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle  # noqa: E402
from shelfcast.operators import dashboard, drivers, projection, quality, scenarios  # noqa: E402
from shelfcast.plans import cycle, validation  # noqa: E402
from shelfcast.functions import sketches  # noqa: E402
from shelfcast.functions.prefix_sum import with_rank  # noqa: E402
from shelfcast.sources import contracts, starschema  # noqa: E402
from shelfcast.sources.commits import drop_table, replace_table  # noqa: E402
from shelfcast.sources.tables import PlanningTables, create_table, materialise, stage_root  # noqa: E402

try:
    import corpus_pipeline
    from shelfcast.llm import queries as text_queries
except ImportError:  # the text operators may be absent
    if (Path(__file__).resolve().parent / "shelfcast" / "llm" / "__init__.py").exists():
        raise
    TEXT_QUERIES, TEXT_ORACLES = {}, {}
else:
    TEXT_QUERIES = {**text_queries.QUERIES, "pipeline": corpus_pipeline.run}
    TEXT_ORACLES = {**text_queries.ORACLES}
    if corpus_pipeline.ORACLE_SQL is not None:
        TEXT_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

Query = Callable[[SparkSession, str], DataFrame]

CALENDAR = starschema.DEFAULT_CALENDAR
KEYS = ["Material_ID", "Site_ID"]
ACTUALS_KEY = ["Demand_Month", "Customer_ID", "Material_ID"]


def _on_tables(build: Callable[[PlanningTables], DataFrame]) -> Query:
    return lambda spark, root: build(starschema.planning_tables(spark, root, CALENDAR))


def _on_actuals(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_tables(lambda t: build(t.actuals))


def _on_supply(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_tables(lambda t: build(t.supply))


def _analysis(t: PlanningTables) -> DataFrame:
    return cycle.analysis_of(t, as_of=CALENDAR.as_of, horizon_months=CALENDAR.horizon_months)


def _profile(t: PlanningTables) -> DataFrame:
    return cycle.profile_of(_analysis(t))


def _on_analysis(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_tables(lambda t: build(_analysis(t)))


def _on_profile(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_tables(lambda t: build(_profile(t)))


def _on_stockouts(build: Callable[[PlanningTables, DataFrame], DataFrame]) -> Query:
    return _on_tables(lambda t: build(t, cycle.stockouts_of(_profile(t), t.materials)))


def _report(t: PlanningTables) -> DataFrame:
    return cycle.report_of(_profile(t), t.materials)


def _on_report(build: Callable[[PlanningTables, DataFrame], DataFrame]) -> Query:
    return _on_tables(lambda t: build(t, _report(t)))


def _pareto(t: PlanningTables) -> DataFrame:
    return drivers.shortfall_pareto(scenarios.supply_coverage(_profile(t)))


def _safety_stock_counts(t: PlanningTables) -> DataFrame:
    limit = F.col("Safety_Stock_Units")
    analysis = cycle.analysis_of(t, as_of=CALENDAR.as_of, horizon_months=CALENDAR.horizon_months, threshold=limit)
    return scenarios.scenario_counts(cycle.profile_of(analysis, threshold=limit))


def _month_coverage(t: PlanningTables) -> DataFrame:
    months = {
        "demand_actuals_raw": (t.actuals, "Demand_Month"),
        "demand_forecast_raw": (t.forecast, "Forecast_Month"),
        "inventory_snapshot_raw": (t.inventory, "Snapshot_Date"),
        "planned_supply_raw": (t.supply, "Receipt_Month"),
    }
    return quality.union_all(
        quality.label(quality.coverage(df, month), Table_Name=name) for name, (df, month) in months.items()
    )


def _with_multi_site(site_mode: str) -> Query:
    def query(spark: SparkSession, root: str) -> DataFrame:
        t = starschema.planning_tables(spark, root, CALENDAR)
        stock = starschema.multi_site_inventory(spark, root, CALENDAR)
        return projection.project_inventory(
            t.forecast, t.supply, stock, as_of=CALENDAR.as_of, horizon_months=CALENDAR.horizon_months, site_mode=site_mode
        )

    return query


def _kpi_by_site(spark: SparkSession, root: str) -> DataFrame:
    t = starschema.planning_tables(spark, root, CALENDAR)
    stock = starschema.multi_site_inventory(spark, root, CALENDAR)
    analysis = projection.stockout_risk_analysis(
        t.forecast, t.supply, stock, as_of=CALENDAR.as_of, horizon_months=CALENDAR.horizon_months, site_mode="by_site"
    )
    report = cycle.report_of(cycle.profile_of(analysis, site_mode="by_site"), t.materials)
    return dashboard.kpi_summary(t.materials, report)


def _with_stored_demand(t: PlanningTables) -> PlanningTables:
    """The tables, of which history and forecast are stored when first used: what reads them several times need not join
    orders and lines each time."""
    stored = ("actuals", "forecast")
    return PlanningTables(lambda field: materialise(getattr(t, field), f"input-{field}") if field in stored else getattr(t, field))


def _stored_cycle(spark: SparkSession, root: str, run: Callable[..., cycle.Cycle], **options: int) -> cycle.Cycle:
    """A planning cycle, every stage in a table of its own, read back."""
    store = f"{stage_root(spark)}/cycles-{uuid.uuid4().hex}"
    t = starschema.planning_tables(spark, root, CALENDAR)
    if run is cycle.refresh:
        t = _with_stored_demand(t)
    save = cycle.cycle_store(store, CALENDAR.as_of)
    return run(t, CALENDAR.as_of, save, horizon_months=CALENDAR.horizon_months, **options)


def _cycle_report(spark: SparkSession, root: str) -> DataFrame:
    return _stored_cycle(spark, root, cycle.run_cycle).report


def _refresh_results(spark: SparkSession, root: str) -> DataFrame:
    """All results of a refresh, from its stored tables: one row of text for each row."""
    stored = _stored_cycle(spark, root, cycle.refresh, history_months=CALENDAR.history_months)
    return quality.union_all(quality.label(_as_text(df), Result=name) for name, df in stored.results().items())


def _as_text(df: DataFrame) -> DataFrame:
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in sorted(set(df.columns) - {"Cycle_Date"})]
    return df.select(F.concat_ws("|", *values).alias("Row_Values"))


def _stored_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows that catalog tables hold after each way of writing them."""
    t = starschema.planning_tables(spark, root, CALENDAR)
    run = uuid.uuid4().hex
    analysis = replace_table(_analysis(t), f"analysis_{run}")
    report = replace_table(cycle.report_of(cycle.profile_of(analysis), t.materials), f"report_{run}", buckets=8)
    stored = {
        "created": create_table(quality.dedupe_exact(t.actuals), f"clean_{run}"),
        "replaced": replace_table(_analysis(t), f"analysis_{run}"),
        "overwritten": replace_table(report.drop("Remaining_Shortfall_Units"), f"stockouts_{run}"),
        "bucketed": report,
    }
    counts = [(sink, df.count()) for sink, df in stored.items()]
    for name in ("analysis", "report", "clean", "stockouts"):
        drop_table(spark, f"{name}_{run}")
    return spark.createDataFrame(counts, "Sink string, Stored_Rows bigint")


def _stored_contents(spark: SparkSession, root: str) -> DataFrame:
    """What catalog tables hold after they were created, replaced by a query on themselves, and replaced with other columns."""
    t = starschema.planning_tables(spark, root, CALENDAR)
    run = uuid.uuid4().hex
    created = create_table(quality.dedupe_exact(t.actuals), f"clean_{run}")
    report = replace_table(_report(t), f"report_{run}", buckets=8)
    coverage = replace_table(report, f"coverage_{run}")
    coverage = replace_table(coverage.where("Remaining_Shortfall_Units > 0"), f"coverage_{run}")
    narrow = replace_table(report.select("Material_ID", "Site_ID", "Stockout_Units"), f"report_{run}")
    stored = {"created": created, "replaced by itself": coverage, "other columns": narrow}
    rows = quality.union_all(quality.label(_as_text(df), Sink=sink) for sink, df in stored.items())
    rows = materialise(rows, "stored-contents")
    for name in ("clean", "report", "coverage"):
        drop_table(spark, f"{name}_{run}")
    return rows


def _without_some_sites(df: DataFrame) -> DataFrame:
    return df.withColumn("Site_ID", F.when(~F.col("Material_ID").endswith("7"), F.col("Site_ID")))


def _reporting_table(t: PlanningTables) -> DataFrame:
    """The two-key join of two stored tables in which some rows have no site."""
    profile = materialise(_profile(t), "profile")
    final = materialise(_without_some_sites(cycle.stockouts_of(profile, t.materials)), "stockouts")
    coverage = materialise(_without_some_sites(scenarios.supply_coverage(profile)), "coverage")
    return drivers.reporting_table(final, coverage)


def _coverage_of_list(t: PlanningTables) -> DataFrame:
    """Supply coverage of the materials that a stored list names: here those that take over 30 days to get."""
    profile = _profile(t)
    final = materialise(cycle.stockouts_of(profile, t.materials).where("Lead_Time_Days > 30"), "stockouts")
    return scenarios.supply_coverage(profile, final)


def _sketched_pairs(t: PlanningTables) -> DataFrame:
    """Customer and material pairs per quarter and over all months, from sketches stored per month, beside exact counts."""
    pair = ["Customer_ID", "Material_ID"]
    quarter = F.date_trunc("quarter", "Demand_Month").cast("date").alias("Quarter")
    stored = materialise(sketches.distinct_sketches(t.actuals, pair, ["Demand_Month"]), "pair-sketches")
    stored = stored.withColumn("Quarter", quarter)
    every = F.lit(None).cast("date").alias("Quarter")
    approx = sketches.merged_distinct(stored, ["Quarter"]).where("Quarter IS NOT NULL")
    approx = approx.unionByName(sketches.merged_distinct(stored).select(every, "Approx_Distinct"))
    complete = t.actuals.where("Customer_ID IS NOT NULL AND Material_ID IS NOT NULL")
    exact = complete.where("Demand_Month IS NOT NULL").groupBy(quarter).agg(F.count_distinct(*pair).alias("Exact_Distinct"))
    exact = exact.unionByName(quality.distinct_count(t.actuals, pair).select(every, F.col("Distinct_Count").alias("Exact_Distinct")))
    error = F.abs(F.col("Approx_Distinct") - F.col("Exact_Distinct"))
    return exact.join(approx, exact["Quarter"].eqNullSafe(approx["Quarter"]), "left").select(
        exact["Quarter"], "Exact_Distinct", (error <= sketches.DISTINCT_BOUND * F.col("Exact_Distinct")).alias("Within_Bound")
    )


QUANTILES = [0.5, 0.9]


def _demand_quantiles(t: PlanningTables) -> DataFrame:
    """Median and 90 % quantile of demand per quarter, exact, and whether those from sketches stored per month agree."""
    quarter = F.date_trunc("quarter", "Demand_Month").cast("date").alias("Quarter")
    rows = t.actuals.where("Demand_Month IS NOT NULL")
    stored = materialise(sketches.quantile_sketches(rows, "Actual_Demand_Units", ["Demand_Month"]), "demand-sketches")
    approx = sketches.merged_quantile(stored.withColumn("Quarter", quarter), QUANTILES, ["Quarter"]).withColumnRenamed("Quantiles", "approx")
    exact = sketches.exact_quantile(rows.withColumn("Quarter", quarter), "Actual_Demand_Units", QUANTILES, ["Quarter"])
    near = F.forall(F.zip_with("Quantiles", "approx", lambda e, a: F.abs(a - e) <= 1.000001 * sketches.ACCURACY * F.abs(e)), lambda x: x)
    return exact.join(approx, "Quarter").select(
        "Quarter", F.col("Quantiles")[0].alias("Median_Demand"), F.col("Quantiles")[1].alias("P90_Demand"), near.alias("Within_Bound")
    )


def _cast_losses(t: PlanningTables) -> DataFrame:
    """The supply table as a text file might bring it: dates and numbers as text, some not readable, and fractions."""
    units = F.col("Planned_Supply_Units")
    as_text = t.supply.withColumns(
        {
            "Receipt_Month": F.when(units % 7 == 0, F.lit("soon")).otherwise(F.col("Receipt_Month").cast("string")),
            "Planned_Supply_Units": (units / 2).cast("double"),
        }
    )
    return contracts.cast_losses(as_text, contracts.PLANNED_SUPPLY)


def _schema_violations(t: PlanningTables) -> DataFrame:
    """The supply table with two columns of another type and one missing."""
    wrong = t.supply.withColumns(
        {"Receipt_Month": F.col("Receipt_Month").cast("string"), "Planned_Supply_Units": F.col("Planned_Supply_Units").cast("int")}
    ).drop("Supply_Status")
    return contracts.schema_violations(wrong, contracts.PLANNED_SUPPLY)


def queries() -> dict[str, Query]:
    return {
        # data quality
        "q_row_count": _on_actuals(quality.row_count),
        "q_key_uniqueness": _on_tables(validation.uniqueness_summary),
        "q_duplicate_groups": _on_actuals(lambda df: quality.duplicate_groups(df, ACTUALS_KEY, "Actual_Demand_Units")),
        "q_duplicate_rows": _on_actuals(lambda df: quality.duplicate_rows(df, ACTUALS_KEY)),
        "q_rows_matching": _on_supply(
            lambda df: quality.rows_matching(
                df, {"Receipt_Month": dt.date(2001, 2, 1), "Supply_Status": "At Risk", "Supply_Type": None}
            )
        ),
        "q_dedupe_exact": _on_actuals(quality.dedupe_exact),
        "q_dedupe_loss": _on_actuals(quality.dedupe_loss),
        "q_required_fields": _on_supply(lambda df: quality.required_fields(df, validation.CHECKS["supply"].required)),
        "q_null_profile": _on_supply(lambda df: quality.null_profile(df, validation.CHECKS["supply"].required)),
        "q_range_violations": _on_tables(lambda t: quality.range_violations(t.inventory, validation.CHECKS["inventory"].rules)),
        "q_rule_counts": _on_actuals(lambda df: quality.rule_counts(df, validation.CHECKS["actuals"].rules)),
        "q_orphans_material": _on_tables(lambda t: validation.orphan_rows(t, "Material_ID")),
        "q_orphans_customer": _on_tables(lambda t: validation.orphan_rows(t, "Customer_ID")),
        "q_orphan_rows": _on_tables(lambda t: quality.orphans(t.actuals, t.customers, "Customer_ID")),
        "q_orphan_keys": _on_tables(lambda t: quality.orphan_keys(t.actuals, t.materials, "Material_ID")),
        "q_month_coverage": _on_tables(_month_coverage),
        "q_distinct_months": _on_actuals(lambda df: quality.distinct_values(df, "Demand_Month")),
        "q_incomplete_history": _on_actuals(
            lambda df: quality.incomplete_history(df, ["Customer_ID", "Material_ID"], "Demand_Month", CALENDAR.history_months)
        ),
        "q_pair_count": _on_actuals(lambda df: quality.distinct_count(df, ["Customer_ID", "Material_ID"])),
        "q_status_distribution": _on_supply(quality.status_distribution),
        "q_multi_site": lambda spark, root: quality.multi_site_materials(starschema.multi_site_inventory(spark, root, CALENDAR)),
        "q_rank_multi_site": lambda spark, root: with_rank(
            quality.multi_site_materials(starschema.multi_site_inventory(spark, root, CALENDAR)), "Site_Count", ["Material_ID"]
        ),
        "q_schema_violations": _on_tables(_schema_violations),
        "q_cast_losses": _on_tables(_cast_losses),
        "q_sketched_pairs": _on_tables(_sketched_pairs),
        "q_demand_quantiles": _on_tables(_demand_quantiles),
        "q_quality_summary": _on_tables(lambda t: validation.quality_summary(t, history_months=CALENDAR.history_months)),
        # projection
        "q_forecast_by_month": _on_tables(lambda t: projection.forecast_by_month(t.forecast)),
        "q_supply_by_status": _on_supply(projection.supply_by_month),
        "q_balance": _on_tables(lambda t: projection.forecast_supply_balance(t.forecast, t.supply)),
        "q_balance_all_months": _on_tables(lambda t: projection.forecast_supply_balance(t.forecast, t.supply, spine="union")),
        "q_unmatched_supply": _on_tables(lambda t: projection.unmatched_supply(t.forecast, t.supply)),
        "q_project_inventory": _on_tables(
            lambda t: projection.project_inventory(
                t.forecast, t.supply, t.inventory, as_of=CALENDAR.as_of, horizon_months=CALENDAR.horizon_months
            )
        ),
        "q_project_pooled_sites": _with_multi_site("pooled"),
        "q_project_by_site": _with_multi_site("by_site"),
        "q_stockout_analysis": _on_tables(_analysis),
        "q_stockout_material_count": _on_analysis(projection.stockout_material_count),
        "q_unknown_inventory": _on_analysis(projection.unknown_inventory),
        "q_first_stockout": _on_analysis(projection.first_stockout),
        "q_stockout_timing": _on_analysis(lambda df: projection.stockout_timing(projection.first_stockout(df))),
        # scenarios and priorities
        "q_scenario_projection": _on_analysis(scenarios.scenario_projection),
        "q_scenario_counts": _on_profile(scenarios.scenario_counts),
        "q_scenario_counts_safety_stock": _on_tables(_safety_stock_counts),
        "q_residual_risk": _on_profile(scenarios.residual_risk),
        "q_rank_residual_risk": _on_profile(
            lambda df: with_rank(scenarios.residual_risk(df), "Lowest_Projected_Inventory", KEYS, ascending=True)
        ),
        "q_prioritise": _on_profile(scenarios.prioritise),
        "q_severity": _on_profile(lambda df: scenarios.severity(scenarios.prioritise(df))),
        "q_rank_priorities": _on_profile(
            lambda df: with_rank(scenarios.prioritise(df), "Worst_Projected_Inventory", KEYS, ascending=True)
        ),
        "q_valued": _on_stockouts(lambda t, final: final),
        "q_stockout_null_profile": _on_stockouts(lambda t, final: quality.null_profile(final, contracts.STOCKOUT_REQUIRED)),
        "q_rank_exposure": _on_stockouts(
            lambda t, final: with_rank(
                final.select(*KEYS, "Stockout_Status", "Stockout_Units", "Stockout_Value_USD"), "Stockout_Value_USD", KEYS
            )
        ),
        "q_top_exposure": _on_report(lambda t, report: scenarios.ranked(report, "Stockout_Value_USD", top=20)),
        "q_status_counts": _on_stockouts(lambda t, final: scenarios.status_counts(final)),
        "q_supply_coverage": _on_profile(scenarios.supply_coverage),
        "q_supply_coverage_of_list": _on_tables(_coverage_of_list),
        "q_rank_supply_coverage": _on_profile(
            lambda df: with_rank(scenarios.supply_coverage(df), "Remaining_Shortfall_Units", KEYS)
        ),
        # drivers and reporting
        "q_lead_time_exposure": _on_stockouts(lambda t, final: drivers.lead_time_exposure(final)),
        "q_critical_rate": _on_stockouts(lambda t, final: drivers.critical_rate_by_lead_time(t.materials, final)),
        "q_demand_signal": _on_stockouts(lambda t, final: drivers.demand_signal_gap(t.forecast, final)),
        "q_rank_demand_signal": _on_stockouts(
            lambda t, final: with_rank(drivers.demand_signal_gap(t.forecast, final), "Customer_Demand_Gap", ["Material_ID"])
        ),
        "q_forecast_change": _on_stockouts(lambda t, final: drivers.forecast_change_by_group(t.forecast, final)),
        "q_pareto": _on_tables(_pareto),
        "q_pareto_priority": _on_tables(lambda t: drivers.pareto_priority(_pareto(t))),
        "q_report": _on_tables(_report),
        "q_reporting_table": _on_tables(_reporting_table),
        "q_report_qa": _on_report(lambda t, report: drivers.report_qa(report)),
        # dashboard
        "q_kpi": _on_report(lambda t, report: dashboard.kpi_summary(t.materials, report)),
        "q_plant_exposure": _on_report(lambda t, report: dashboard.plant_exposure(report)),
        "q_recovery_timing": _on_report(lambda t, report: dashboard.recovery_timing(report, CALENDAR.as_of)),
        "q_kpi_by_site": _kpi_by_site,
        "q_cycle_report": _cycle_report,
        "q_refresh_results": _refresh_results,
        "q_stored_rows": _stored_rows,
        "q_stored_contents": _stored_contents,
        **TEXT_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return {**oracle.statements(), **TEXT_ORACLES}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the material-by-month stockout analysis on the smallest data set."""
    return queries()["q_stockout_analysis"](spark, "/root/testdata/sf0.001")
