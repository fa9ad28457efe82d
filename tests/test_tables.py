"""Contracts, readers, writers and a stored cycle."""

from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from planning_case import AS_OF, rows, tables
from shelfcast.operators import drivers, quality
from shelfcast.operators.scenarios import supply_coverage
from shelfcast.plans import cycle, job
from shelfcast.session import shuffle_partitions
from shelfcast.sources import contracts, starschema
from shelfcast.sources.commits import read_cycle, replace_table, write_cycle
from shelfcast.sources.tables import (
    INPUTS,
    create_table,
    materialise,
    read_inputs,
    read_table,
    release,
    stage_root,
    stored_so_far,
)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("inputs"))
    for field, data in rows().items():
        spark.createDataFrame(data, contracts.SCHEMAS[INPUTS[field]]).write.parquet(f"{root}/{INPUTS[field]}")
    return root


def test_inputs_from_files(spark, stored):
    t = read_inputs(spark, root=stored)
    assert t.forecast.count() == 17
    assert t.materials is t.materials
    assert t.customers.count() == 1


def test_contract_violations(spark):
    df = spark.createDataFrame([("C1", 1)], "Customer_ID string, extra int")
    assert contracts.schema_violations(df, contracts.CUSTOMER_MASTER).count() == 0
    assert contracts.enforce(df, contracts.CUSTOMER_MASTER).columns == ["Customer_ID"]

    wrong = spark.createDataFrame([(1,)], "Customer_ID int")
    assert [tuple(r) for r in contracts.schema_violations(wrong, contracts.CUSTOMER_MASTER).collect()] == [
        ("customer_master_raw", "Customer_ID", "string", "int")
    ]
    with pytest.raises(contracts.ContractError, match="Customer_ID: expected string, found int"):
        contracts.enforce(wrong, contracts.CUSTOMER_MASTER)
    assert contracts.enforce(wrong, contracts.CUSTOMER_MASTER, cast=True).schema["Customer_ID"].dataType.simpleString() == "string"

    with pytest.raises(contracts.ContractError, match="found nothing"):
        contracts.enforce(df.drop("Customer_ID"), contracts.CUSTOMER_MASTER, cast=True)


def test_outputs_keep_their_contracts(spark):
    t = tables(spark)
    analysis = cycle.analysis_of(t)
    profile = cycle.profile_of(analysis)
    final = cycle.stockouts_of(profile, t.materials)
    report = drivers.reporting_table(final, supply_coverage(profile))
    for df, name in [(analysis, contracts.ANALYSIS), (final, contracts.STOCKOUTS), (report, contracts.REPORT)]:
        assert contracts.schema_problems(df, name) == []
        assert df.columns == contracts.SCHEMAS[name].names


def test_catalog_tables(spark):
    t = tables(spark)
    clean = create_table(quality.dedupe_exact(t.actuals), contracts.DEMAND_ACTUALS_CLEAN)
    assert clean.count() == 0
    with pytest.raises(AnalysisException, match="already exists"):
        create_table(t.actuals, contracts.DEMAND_ACTUALS_CLEAN)

    result = cycle.run_cycle(t, AS_OF, replace_table)
    assert read_table(spark, contracts.ANALYSIS).count() == 17
    assert result.report.count() == 4
    # A second run replaces the tables.
    cycle.run_cycle(t, AS_OF, replace_table)
    assert read_table(spark, contracts.REPORT).count() == 4


def test_bucketed_table_needs_no_shuffle_by_material(spark):
    analysis = replace_table(cycle.analysis_of(tables(spark)), "analysis_bucketed", buckets=4)
    assert analysis.count() == 17
    plan = analysis.groupBy("Material_ID").agg(F.min("Month"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_cycles_are_kept_apart_and_reruns_replace(spark, tmp_path):
    t, later = tables(spark), dt.date(2026, 9, 30)
    for as_of in (AS_OF, later, AS_OF):
        result = cycle.run_cycle(t, as_of, cycle.cycle_store(str(tmp_path), as_of))
    assert result.report.count() == 4
    assert read_cycle(spark, str(tmp_path), contracts.REPORT).count() == 6
    assert read_cycle(spark, str(tmp_path), contracts.REPORT, later).count() == 2
    plan = read_cycle(spark, str(tmp_path), contracts.REPORT, later)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Cycle_Date" in plan

    assert result.pareto.count() == 3
    counts = {name: df.count() for name, df in result.results().items()}
    assert counts == {
        "stockout_timing": 2,
        "scenario_counts": 1,
        "status_counts": 2,
        "stockout_null_profile": 1,
        "lead_time_exposure": 3,
        "critical_rate_by_lead_time": 4,
        "demand_signal_gap": 3,
        "forecast_change_by_group": 2,
        "pareto_priority": 2,
        "report_qa": 1,
        "kpi_summary": 1,
        "plant_exposure": 2,
        "recovery_timing": 4,
    }


def test_job_refreshes_everything_from_files(spark, stored, tmp_path):
    out = str(tmp_path / "cycles")
    job.run(spark, job.arguments(["--as-of", str(AS_OF), "--inputs", stored, "--out", out]))
    names = {path.name for path in (tmp_path / "cycles").iterdir()}
    assert names == {
        "_commits",
        "quality_summary",
        "demand_actuals_clean",
        "stockout_risk_analysis",
        "stockout_risk_profile",
        "stockout_risk_powerbi",
        "stockout_risk_powerbi_final",
        "stockout_timing",
        "scenario_counts",
        "status_counts",
        "stockout_null_profile",
        "lead_time_exposure",
        "critical_rate_by_lead_time",
        "demand_signal_gap",
        "forecast_change_by_group",
        "shortfall_pareto",
        "pareto_priority",
        "report_qa",
        "kpi_summary",
        "plant_exposure",
        "recovery_timing",
    }
    assert read_cycle(spark, out, "kpi_summary", AS_OF).first().Critical_Gap_Units == 57


def test_an_empty_plan(spark):
    """No input rows at all: every result exists, and the counts are zero."""
    t = tables(spark, materials=[], customers=[], forecast=[], inventory=[], supply=[])
    result = cycle.run_cycle(t, AS_OF, materialise)
    got = {name: [tuple(r) for r in df.collect()] for name, df in result.results().items()}
    assert got.pop("scenario_counts") == [(0, 0, 0, 0, 0)]
    assert got.pop("report_qa") == [(0, 0, 0, 0, 0, 0)]
    assert [float(v) for v in got.pop("kpi_summary")[0]] == [0, 0, 0, 0, 0]
    assert got.pop("stockout_null_profile") == [(0,) * 8]
    assert set(map(tuple, got.values())) == {()}


def test_intermediate_tables_go_to_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert stage_root(spark) == root
    df = materialise(spark.range(3), "numbers")
    assert sorted(r.id for r in df.collect()) == [0, 1, 2]
    assert all(root in f for f in df.inputFiles())


def test_intermediate_tables_are_removed_when_their_reader_is_done(spark, tmp_path):
    stage, mark = Path(stage_root(spark)), stored_so_far()
    before = set(stage.iterdir()) if stage.exists() else set()
    cycle.run_cycle(tables(spark), AS_OF, cycle.cycle_store(str(tmp_path), AS_OF))
    assert set(stage.iterdir()) == before and stored_so_far() == mark
    materialise(spark.range(3), "numbers")
    release(spark, mark)
    assert set(stage.iterdir()) == before
    materialise(spark.range(4), "early")
    late = materialise(spark.range(3), "late")
    release(spark, mark, mark + 1)
    assert late.count() == 3 and len(set(stage.iterdir()) - before) == 1
    release(spark, mark)
    assert set(stage.iterdir()) == before


def test_a_failing_rerun_leaves_its_cycle(spark, tmp_path):
    write_cycle(spark.range(3), str(tmp_path), "numbers", AS_OF)
    with pytest.raises(PySparkException):
        write_cycle(spark.range(2).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")), str(tmp_path), "numbers", AS_OF)
    assert read_cycle(spark, str(tmp_path), "numbers", AS_OF).count() == 3


def test_a_star_schema_with_a_missing_column_is_refused(spark, tmp_path):
    spark.range(1).selectExpr("id AS p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    with pytest.raises(contracts.ContractError, match="p_name"):
        starschema.inventory_snapshot(spark, str(tmp_path))


ROOT = Path(__file__).resolve().parents[1]


def test_the_documented_command_starts(tmp_path):
    done = subprocess.run(
        [sys.executable, str(ROOT / "shelfcast/plans/job.py"), "--help"], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0 and "--as-of" in done.stdout, done.stderr


def test_the_submitters_shuffle_partitions_stay(tmp_path):
    code = "from shelfcast.session import builder; print('n =', builder().getOrCreate().conf.get('spark.sql.shuffle.partitions'))"
    env = os.environ | {
        "PYTHONPATH": str(ROOT),
        "PYSPARK_SUBMIT_ARGS": "--master local[1] --conf spark.sql.shuffle.partitions=400 pyspark-shell",
    }
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "n = 400" in done.stdout, done.stderr


def test_write_cycle_returns_the_stored_rows(spark, tmp_path):
    df = write_cycle(spark.range(3), str(tmp_path), "numbers", AS_OF)
    assert {(r.id, r.Cycle_Date) for r in df.collect()} == {(i, AS_OF) for i in range(3)}


def test_a_rerun_without_rows_empties_its_cycle(spark, tmp_path):
    write_cycle(spark.range(3), str(tmp_path), "numbers", AS_OF)
    write_cycle(spark.range(5), str(tmp_path), "numbers", dt.date(2026, 9, 30))
    assert write_cycle(spark.range(0), str(tmp_path), "numbers", AS_OF).count() == 0
    assert read_cycle(spark, str(tmp_path), "numbers").count() == 5


def test_shuffle_partitions_follow_the_volume():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(10 * 1024**4, 8) == 81920


def test_what_a_cast_would_lose(spark):
    rows = [("S1", "M", "L", "2026-01-01", 5.0, "Planned", "x"), ("S2", "M", "L", "soon", 2.5, "Planned", "x"),
            ("S3", "M", "L", None, None, None, None), ("S4", "M", "L", "2026-02-30", 1e30, "Planned", "x")]
    schema = (
        "Supply_ID string, Material_ID string, Site_ID string, Receipt_Month string, Planned_Supply_Units double, "
        "Supply_Status string, Supply_Type string"
    )
    df = spark.createDataFrame(rows, schema)
    found = sorted(map(tuple, contracts.cast_losses(df, contracts.PLANNED_SUPPLY).collect()))
    table = contracts.PLANNED_SUPPLY
    assert found == [
        (table, "Planned_Supply_Units", "bigint", "double", 1, 1),
        (table, "Receipt_Month", "date", "string", 2, 0),
    ]
    right = contracts.enforce(df.limit(1), table, cast=True)
    assert contracts.cast_losses(right, table).collect() == []
    assert contracts.cast_losses(df.drop("Receipt_Month", "Planned_Supply_Units"), table).collect() == []
