"""Hand-checked results on the planning case."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from planning_case import AS_OF, M1, M2, M3, tables
from shelfcast.functions.prefix_sum import with_rank
from shelfcast.operators import dashboard, drivers, projection, scenarios
from shelfcast.plans import cycle


@pytest.fixture(scope="module")
def t(spark):
    return tables(spark)


@pytest.fixture(scope="module")
def analysis(t):
    return cycle.analysis_of(t)


@pytest.fixture(scope="module")
def projected(analysis):
    return scenarios.scenario_projection(analysis)


@pytest.fixture(scope="module")
def profile(projected):
    return scenarios.risk_profile(projected)


@pytest.fixture(scope="module")
def final(t, profile):
    return cycle.stockouts_of(profile, t.materials)


@pytest.fixture(scope="module")
def coverage(profile):
    return scenarios.supply_coverage(profile)


@pytest.fixture(scope="module")
def report(final, coverage):
    return drivers.reporting_table(final, coverage)


def keyed(df, *columns, key=("Material_ID",)):
    return {tuple(row[k] for k in key): tuple(row[c] for c in columns) for row in df.collect()}


def by_material(df, *columns):
    return {k[0]: v for k, v in keyed(df, *columns).items()}


def test_projection_under_all_scenarios(projected):
    got = keyed(
        projected,
        "Projected_Inventory",
        "Projected_Inventory_With_Planned",
        "Projected_Inventory_With_At_Risk",
        "Stockout_Risk_Flag",
        key=("Material_ID", "Month"),
    )
    assert got == {
        ("A", M1): (100, 100, 100, 0),
        ("A", M2): (50, 50, 50, 0),
        ("A", M3): (0, 0, 0, 0),
        ("B", M1): (-10, 5, 5, 1),
        ("B", M2): (-10, 5, 5, 1),
        ("B", M3): (-10, 5, 5, 1),
        ("C", M1): (0, 0, 0, 0),
        ("C", M2): (-10, -5, 0, 1),
        ("C", M3): (-20, -15, 0, 1),
        ("D", M1): (-15, -15, -15, 1),
        ("D", M2): (-35, -35, -35, 1),
        ("D", M3): (-55, -50, -45, 1),
        ("E", M1): (None, None, None, 0),
        ("E", M2): (None, None, None, 0),
        ("E", M3): (None, None, None, 0),
        ("F", M1): (-7, -7, -7, 1),
        ("H", M1): (-5, -5, -5, 1),
    }


def test_unknown_supply_is_carried_but_not_used(analysis):
    got = keyed(analysis, "Unknown_Supply", "Projected_Inventory", key=("Material_ID", "Month"))
    assert got["D", M1] == (100, -15)


def test_all_months_spine_keeps_supply_without_forecast(t):
    balance = projection.forecast_supply_balance(t.forecast, t.supply, spine="union")
    got = keyed(balance, "Forecast_Units", "Confirmed_Supply", key=("Material_ID", "Month"))
    assert len(got) == 18
    assert got["F", M3] == (0, 50)


def test_missing_keys_of_forecast_and_supply_do_not_meet(spark):
    case = tables(
        spark,
        forecast=[(None, "C1", "A", 5, 5, 5), (M1, "C1", None, 6, 6, 6)],
        supply=[("S1", "A", "S1", None, 50, "Confirmed", "x"), ("S2", None, "S1", M1, 50, "Confirmed", "x")],
    )
    balance = projection.forecast_supply_balance(case.forecast, case.supply)
    assert keyed(balance, "Forecast_Units", "Confirmed_Supply", key=("Material_ID", "Month")) == {
        ("A", None): (5, 0),
        (None, M1): (6, 0),
    }


def test_stockout_counts_and_timing(analysis):
    assert projection.stockout_material_count(analysis).collect()[0][0] == 5
    first = projection.first_stockout(analysis)
    assert by_material(first, "First_Stockout_Month") == {"B": (M1,), "C": (M2,), "D": (M1,), "F": (M1,), "H": (M1,)}
    assert [tuple(r) for r in projection.stockout_timing(first).collect()] == [(M1, 4), (M2, 1)]
    assert tuple(projection.unknown_inventory(analysis).collect()[0]) == (1, 3)


def test_scenario_counts(profile):
    assert tuple(scenarios.scenario_counts(profile).collect()[0]) == (5, 4, 3, 1, 1)


def test_residual_risk(profile):
    got = by_material(scenarios.residual_risk(profile), "Site_ID", "Lowest_Projected_Inventory")
    assert got == {"C": ("S2", -15), "D": ("S2", -50), "F": ("S3", -7), "H": ("S3", -5)}


def test_priorities(profile):
    got = by_material(
        scenarios.prioritise(profile),
        "First_Stockout_Month",
        "Worst_Projected_Inventory",
        "Critical_Stockout_Flag",
        "Stockout_Status",
    )
    assert got == {
        "C": (M2, -15, 0, "Stockout"),
        "D": (M1, -50, 1, "Critical Stockout"),
        "F": (M1, -7, 1, "Critical Stockout"),
        "H": (M1, -5, 1, "Critical Stockout"),
    }


def test_values(final):
    assert by_material(final, "Stockout_Units", "Stockout_Value_USD") == {
        "C": (15, Decimal("307.50")),
        "D": (50, Decimal("500.00")),
        "F": (7, None),
        "H": (5, Decimal("16.75")),
    }


def test_ranked_is_worst_first_with_unknown_values_last(final):
    order = [row.Material_ID for row in scenarios.ranked(final, "Stockout_Value_USD").collect()]
    assert order == ["D", "C", "H", "F"]
    assert [row.Material_ID for row in scenarios.ranked(final, "Stockout_Value_USD", top=2).collect()] == ["D", "C"]


def test_lead_time_exposure(final):
    got = keyed(
        drivers.lead_time_exposure(final),
        "Material_Count",
        "Stockout_Value_USD",
        key=("Lead_Time_Band", "Stockout_Status"),
    )
    assert got == {
        ("31–60 Days", "Stockout"): (1, Decimal("307.50")),
        ("61–90 Days", "Critical Stockout"): (1, Decimal("500.00")),
        (">90 Days", "Critical Stockout"): (2, Decimal("16.75")),
    }


def test_unknown_lead_time_can_have_its_own_band(final):
    got = keyed(
        drivers.lead_time_exposure(final, unknown="Unknown"), "Material_Count", key=("Lead_Time_Band", "Stockout_Status")
    )
    assert got["Unknown", "Critical Stockout"] == (1,)
    assert got[">90 Days", "Critical Stockout"] == (1,)


def test_critical_rate_by_lead_time(t, final):
    rates = drivers.critical_rate_by_lead_time(t.materials, final)
    assert [tuple(r) for r in drivers.by_lead_time(rates).collect()] == [
        ("≤30 Days", 1, 0, 0.0),
        ("31–60 Days", 2, 0, 0.0),
        ("61–90 Days", 2, 1, 50.0),
        (">90 Days", 2, 2, 100.0),
    ]


def test_demand_signal_gap(t, final):
    got = by_material(drivers.demand_signal_gap(t.forecast, final), "Customer_Demand_Gap", "Forecast_Change")
    assert got == {"D": (-6, 18), "F": (-2, 7), "H": (-2, 1)}


def test_forecast_change(t, final):
    changes = drivers.forecast_change_by_group(t.forecast, final)
    assert keyed(
        changes, "Material_Count", "Avg_Forecast_Change_Pct", "Median_Forecast_Change_Pct", key=("Risk_Group",)
    ) == {("Critical Stockout",): (3, 25.0, 25.0), ("Other Materials",): (4, 0.0, 0.0)}


def test_supply_coverage(coverage):
    got = by_material(
        coverage, "Six_Month_Forecast", "Confirmed_Supply", "Planned_Supply", "At_Risk_Supply", "Remaining_Shortfall_Units"
    )
    assert got == {"D": (90, 30, 5, 5, 45), "F": (7, 0, 0, 0, 7), "H": (5, 0, 0, 0, 5)}


def test_supply_coverage_of_a_stored_stockout_list(profile, final):
    listed = final.filter("Material_ID <> 'D'")
    assert by_material(scenarios.supply_coverage(profile, listed), "Remaining_Shortfall_Units") == {"F": (7,), "H": (5,)}


def test_pareto(coverage):
    pareto = drivers.shortfall_pareto(coverage)
    assert by_material(pareto, "Shortfall_Share_Pct", "Cumulative_Shortfall_Units", "Cumulative_Shortfall_Pct") == {
        "D": (78.9, 45, 78.9),
        "F": (12.3, 52, 91.2),
        "H": (8.8, 57, 100.0),
    }
    assert set(by_material(drivers.pareto_priority(pareto))) == {"D", "F"}
    assert set(by_material(drivers.pareto_priority(pareto, threshold=0.5))) == {"D"}


def test_report_and_its_controls(report):
    assert by_material(report, "Remaining_Shortfall_Units") == {"C": (0,), "D": (45,), "F": (7,), "H": (5,)}
    assert tuple(drivers.report_qa(report).collect()[0]) == (4, 3, 1, 57, 0, 1)


def test_dashboard(t, report):
    assert tuple(dashboard.kpi_summary(t.materials, report).collect()[0]) == (7, 4, 3, 57, Decimal("824.25"))
    sites = keyed(
        dashboard.plant_exposure(report), "Materials", "Stockout_Units", "Stockout_Value_USD", key=("Site_ID",)
    )
    assert sites == {("S2",): (2, 65, Decimal("807.50")), ("S3",): (2, 12, Decimal("16.75"))}


def test_recovery_timing(report):
    assert by_material(dashboard.recovery_timing(report, AS_OF), "Recovery_By", "Days_To_Act", "Overdue") == {
        "D": (dt.date(2026, 7, 2), -60, True),
        "C": (dt.date(2026, 8, 2), -29, True),
        "H": (dt.date(2026, 6, 2), -90, True),
        "F": (None, None, None),
    }


# --- several sites -----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def two_sites(spark):
    return tables(
        spark,
        forecast=[(month, "C1", "G", 15, 15, 15) for month in (M1, M2)],
        supply=[],
        inventory=[(AS_OF, "G", "S1", 10, 0, 10, 1), (AS_OF, "G", "S2", 20, 0, 20, 2)],
    )


def test_single_site_mode_refuses_several_rows(two_sites):
    with pytest.raises(PySparkException, match="several inventory rows for G"):
        cycle.analysis_of(two_sites).collect()


def test_by_site(two_sites):
    got = keyed(cycle.analysis_of(two_sites, site_mode="by_site"), "Projected_Inventory", key=("Site_ID", "Month"))
    assert got == {("S1", M1): (5,), ("S1", M2): (0,), ("S2", M1): (10,), ("S2", M2): (0,)}


def test_by_site_keeps_materials_without_stock(spark):
    case = tables(spark)
    got = cycle.analysis_of(case, site_mode="by_site")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, cycle.analysis_of(case).collect()), key=repr)


def test_pooled(two_sites):
    got = keyed(
        cycle.analysis_of(two_sites, site_mode="pooled"), "Projected_Inventory", "Safety_Stock_Units", key=("Site_ID", "Month")
    )
    assert got == {("ALL", M1): (15, 3), ("ALL", M2): (0, 3)}


def test_a_material_is_critical_at_all_its_sites_if_it_is_at_one(spark):
    case = tables(
        spark,
        forecast=[(M1, "C1", "G", 30, 30, 30)],
        supply=[("S1", "G", "S1", M1, 8, "At Risk", "x")],
        inventory=[(AS_OF, "G", "S1", 10, 0, 10, 0), (AS_OF, "G", "S2", 10, 0, 10, 0)],
    )
    profile = cycle.profile_of(cycle.analysis_of(case, site_mode="by_site"), site_mode="by_site")
    got = keyed(scenarios.prioritise(profile), "Worst_Projected_Inventory", "Stockout_Status", key=("Site_ID",))
    assert got == {("S1",): (-5, "Critical Stockout"), ("S2",): (-5, "Critical Stockout")}
    # The receipt for S1 covers S1 and rescues nobody else.
    remaining = keyed(scenarios.supply_coverage(profile), "Remaining_Shortfall_Units", key=("Site_ID",))
    assert remaining == {("S1",): (0,), ("S2",): (5,)}


def test_sites_without_stock_and_receipts_without_site(spark):
    case = tables(
        spark,
        forecast=[(M1, "C1", "G", 7, 7, 7), (M1, "C1", "N", 7, 7, 7), (M1, "C1", "U", 9, 9, 9)],
        supply=[
            ("1", "G", "S9", M1, 4, "Confirmed", "x"),
            ("2", "G", None, M1, 2, "Confirmed", "x"),
            ("3", "U", "S1", M1, 5, "Confirmed", "x"),
            ("4", "U", None, M1, 5, "Confirmed", "x"),
        ],
        inventory=[(AS_OF, "G", "S1", 1, 0, 1, 3), (AS_OF, "G", "S2", 2, 0, 2, 4), (AS_OF, "N", "S2", 0, 0, -1, 4),
                   (AS_OF, "N", "S1", 0, 0, 0, 4)],
    )
    got = keyed(
        cycle.analysis_of(case, site_mode="by_site"),
        "Starting_Inventory", "Forecast_Units", "Confirmed_Supply", "Projected_Inventory",
        key=("Material_ID", "Site_ID"),
    )
    assert got == {
        ("G", "S1"): (1, 2, 2, 1),
        ("G", "S2"): (2, 5, 0, -3),
        ("G", "S9"): (0, 0, 4, 4),
        ("N", "S1"): (0, 7, 0, -7),
        ("N", "S2"): (-1, 0, 0, -1),
        ("U", None): (None, 9, 10, None),
    }


def test_a_site_not_counted_last_keeps_its_stock(spark):
    early = dt.date(2026, 8, 30)
    case = tables(
        spark,
        forecast=[(M1, "C1", "G", 15, 15, 15), (M1, "C1", "K", 5, 5, 5)],
        supply=[],
        inventory=[(early, "G", "S1", 100, 0, 100, 0), (AS_OF, "K", "S1", 4, 0, 4, 0)],
    )
    assert by_material(cycle.analysis_of(case, as_of=AS_OF), "Projected_Inventory") == {"G": (85,), "K": (-1,)}


def test_horizon(t):
    def months(**options):
        return {row.Month for row in cycle.analysis_of(t, **options).collect()}

    assert months(as_of=AS_OF) == {M1, M2, M3}
    assert months(as_of=AS_OF, horizon_months=2) == {M1, M2}
    assert months(as_of=dt.date(2026, 9, 30), horizon_months=6) == {M2, M3}


def test_a_missing_site_keeps_its_remaining_shortage(spark):
    case = tables(spark, forecast=[(M1, "C1", "D", 15, 15, 15)], supply=[], inventory=[(AS_OF, "D", None, 5, 0, 5, 0)])
    profile = cycle.profile_of(cycle.analysis_of(case))
    assert by_material(cycle.report_of(profile, case.materials), "Remaining_Shortfall_Units") == {"D": (10,)}
    joined = drivers.reporting_table(cycle.stockouts_of(profile, case.materials), scenarios.supply_coverage(profile))
    assert by_material(joined, "Remaining_Shortfall_Units") == {"D": (10,)}


def test_the_carried_report_is_the_joined_one(t, profile, report):
    carried = cycle.report_of(profile, t.materials)
    assert carried.columns == report.columns
    assert sorted(map(tuple, carried.collect()), key=repr) == sorted(map(tuple, report.collect()), key=repr)


def test_keyless_receipts_are_kept_apart_or_counted(spark):
    case = tables(
        spark,
        forecast=[(None, "C1", "A", 5, 5, 5), (M1, "C1", None, 6, 6, 6), (M1, "C1", "A", 7, 7, 7)],
        supply=[("1", "A", "S1", None, 4, "Confirmed", "x"), ("2", None, "S1", M1, 8, "Confirmed", "x"),
                ("3", "A", "S1", M2, 2, "Planned", "x"), ("4", "A", "S1", M1, 1, "Planned", "x")],
    )
    balance = projection.forecast_supply_balance(case.forecast, case.supply, spine="union")
    got = sorted(((r.Material_ID, r.Month, r.Forecast_Units, r.Confirmed_Supply, r.Planned_Supply) for r in balance.collect()), key=repr)
    assert got == sorted(
        [("A", None, 5, 0, 0), (None, M1, 6, 0, 0), ("A", M1, 7, 0, 1), ("A", None, 0, 4, 0), (None, M1, 0, 8, 0), ("A", M2, 0, 0, 2)],
        key=repr,
    )
    assert tuple(projection.unmatched_supply(case.forecast, case.supply).first()) == (2, 12, 1, 2)


def test_median_is_exact_at_every_size(spark):
    n = 25_001
    forecast = spark.range(n).selectExpr(
        "date'2026-09-01' AS Forecast_Month", "'C' AS Customer_ID", "'M' || id AS Material_ID",
        "1000 + (id * 7919) % 1009 AS Current_Forecast_Units", "0L AS Customer_Demand_Units", "1000L AS Prior_Cycle_Forecast_Units",
    )
    final = spark.createDataFrame([], "Material_ID string, Stockout_Status string")
    row = drivers.forecast_change_by_group(forecast, final).first()
    changes = sorted(round((i * 7919) % 1009 / 10, 1) for i in range(n))
    assert row.Median_Forecast_Change_Pct == changes[(n - 1) // 2]


def test_ranks_follow_the_order(final):
    ranks = by_material(with_rank(final, "Stockout_Value_USD", ["Material_ID", "Site_ID"], buckets=3), "Rank")
    assert ranks == {"D": (1,), "C": (2,), "H": (3,), "F": (4,)}


def test_own_scenarios(analysis):
    both = {"Both": ("Confirmed_Supply", "Planned_Supply", "At_Risk_Supply", "Unknown_Supply")}
    projected = scenarios.scenario_projection(analysis, {**scenarios.SCENARIOS, **both})
    labels = {"Confirmed": scenarios.CONFIRMED, "Everything": "Both"}
    profile = scenarios.risk_profile(projected, scenarios=labels, rescue="Both")
    assert tuple(scenarios.scenario_counts(profile, list(labels)).first()) == (5, 2, 3)
    assert {r.Material_ID for r in scenarios.prioritise(profile).where("Critical_Stockout_Flag = 1").collect()} == {"F", "H"}


def test_only_the_latest_known_snapshot_counts(spark):
    days = [dt.date(2026, 7, 31), AS_OF, dt.date(2026, 9, 30)]
    case = tables(
        spark,
        forecast=[(M1, "C1", "G", 15, 15, 15)],
        supply=[],
        inventory=[(day, "G", "S1", 0, 0, 10 * i, 0) for i, day in enumerate(days, 1)],
    )
    assert [row.Starting_Inventory for row in cycle.analysis_of(case, as_of=AS_OF).collect()] == [20]


def test_threshold(t):
    analysis = projection.stockout_risk_analysis(t.forecast, t.supply, t.inventory, threshold=1)
    got = keyed(analysis, "Stockout_Risk_Flag", key=("Material_ID", "Month"))
    assert got["A", M3] == (1,)
    profile = cycle.profile_of(analysis, threshold=1)
    assert scenarios.scenario_counts(profile).first().At_Risk_Confirmed == projection.stockout_material_count(analysis).first()[0]
    assert by_material(scenarios.severity(scenarios.prioritise(profile, shortages=True)), "Projected_Shortfall_Units")["A"] == (1,)


@pytest.mark.parametrize("option", [{"spine": "none"}, {"site_mode": "none"}])
def test_unknown_options_are_rejected(t, option):
    with pytest.raises(ValueError, match="must be one of"):
        cycle.analysis_of(t, **option)


def test_shares_of_sites_are_computed_once(two_sites):
    stock = projection.opening_stock(two_sites.inventory, site_mode="by_site")
    flow = projection.site_balance(two_sites.forecast, two_sites.supply, stock)
    assert "Window" not in flow._jdf.queryExecution().optimizedPlan().toString()
    got = keyed(flow, "Starting_Inventory", "Forecast_Units", key=("Site_ID", "Month"))
    assert got == {("S1", M1): (10, 5), ("S1", M2): (10, 5), ("S2", M1): (20, 10), ("S2", M2): (20, 10)}


def test_rows_of_sites_are_joined_not_stacked_and_summed(two_sites):
    stock = projection.opening_stock(two_sites.inventory, as_of=AS_OF, site_mode="by_site")
    shares = projection.site_shares(stock, two_sites.supply)
    flow = projection.site_balance(two_sites.forecast, two_sites.supply, stock)
    for df in (shares, flow):
        assert "Union" not in df._jdf.queryExecution().optimizedPlan().toString()
    # one count of the day, one last day, one distinct site: nothing is grouped by material and site a fourth time
    assert shares._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 3


@pytest.mark.parametrize("spine", projection.SPINES)
def test_sites_with_missing_keys_and_values(spark, spine):
    case = tables(
        spark,
        forecast=[(M1, "C1", "G", 9, 9, 9), (M1, "C1", "N", 4, 4, 4), (M1, "C1", None, 3, 3, 3), (None, "C1", "G", 5, 5, 5),
                  (M2, "C1", "G", None, 1, 1)],
        supply=[("1", "G", None, M1, 7, "Confirmed", "x"), ("2", "G", "S1", M1, 1, "Confirmed", "x"),
                ("3", "G", "S9", M2, 2, "Planned", "x"), ("4", "N", "S1", M1, 6, "Confirmed", "x"),
                ("5", None, "S1", M1, 8, "Confirmed", "x"), ("6", "G", "S2", None, 3, "Confirmed", "x"),
                ("7", "G", "S2", M3, 2, None, "x")],
        inventory=[(AS_OF, "G", "S1", 10, 0, 10, 1), (AS_OF, "G", "S2", 20, 0, 20, 2)],
    )
    stock = projection.opening_stock(case.inventory, as_of=AS_OF, site_mode="by_site")
    flow = projection.site_balance(case.forecast, case.supply, stock, spine=spine)
    columns = ("Material_ID", "Site_ID", "Month", "Starting_Inventory", "Forecast_Units", "Confirmed_Supply", "Planned_Supply", "Unknown_Supply")
    expected = [
        ("G", "S1", M1, 10, 3, 8, 0, 0), ("G", "S2", M1, 20, 6, 0, 0, 0), ("G", "S9", M1, 0, 0, 0, 0, 0),
        ("G", "S1", M2, 10, None, 0, 0, 0), ("G", "S2", M2, 20, None, 0, 0, 0), ("G", "S9", M2, 0, None, 0, 2, 0),
        ("G", "S1", None, 10, 1, 0, 0, 0), ("G", "S2", None, 20, 4, 0, 0, 0), ("G", "S9", None, 0, 0, 0, 0, 0),
        ("N", None, M1, None, 4, 6, 0, 0), (None, None, M1, None, 3, 0, 0, 0),
    ]
    if spine == "union":  # receipts without material, without month, and of a month without forecast
        expected += [(None, None, M1, None, 0, 8, 0, 0), ("G", "S2", None, 20, 0, 3, 0, 0), ("G", "S2", M3, 20, 0, 0, 0, 2)]
    assert sorted(map(tuple, flow.select(*columns).collect()), key=repr) == sorted(expected, key=repr)
