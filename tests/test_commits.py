"""Overwrites as commits: what readers see when a run fails at any point."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from planning_case import AS_OF, rows, tables
from shelfcast.plans import cycle
from shelfcast.sources import commits, contracts
from shelfcast.sources.commits import CycleRun, drop_table, read_cycle, replace_table, vacuum, write_cycle

LATER = dt.date(2026, 9, 30)


def ids(df):
    return sorted(r.id for r in df.collect())


def runs(root, name, date=AS_OF):
    return sorted(p.name for p in Path(root, name, f"Cycle_Date={date}").glob("Run=*"))


def test_rows_are_whole_before_and_old_ones_stay_until_the_pointer_moves(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    write_cycle(spark.range(3), root, "numbers", AS_OF)
    seen, publish = [], commits._publish

    def stopped(files, file, named):
        seen.append(runs(root, "numbers"))
        raise OSError("the store is gone")

    monkeypatch.setattr(commits, "_publish", stopped)
    with pytest.raises(OSError, match="gone"):
        write_cycle(spark.range(5), root, "numbers", AS_OF)
    assert len(seen[0]) == 2  # both runs lay there when it failed
    assert ids(read_cycle(spark, root, "numbers", AS_OF)) == [0, 1, 2] and len(runs(root, "numbers")) == 1
    monkeypatch.setattr(commits, "_publish", publish)
    assert ids(write_cycle(spark.range(5), root, "numbers", AS_OF)) == [0, 1, 2, 3, 4]


def test_a_killed_run_leaves_no_trace_for_readers(spark, tmp_path):
    root = str(tmp_path)
    write_cycle(spark.range(3), root, "numbers", AS_OF)
    killed = CycleRun(root, AS_OF)
    assert ids(killed(spark.range(9), "numbers")) == list(range(9))  # its own rows, for itself
    (tmp_path / "_commits" / str(AS_OF) / "00000002.json").write_text("")  # died while it wrote the manifest
    assert ids(read_cycle(spark, root, "numbers", AS_OF)) == [0, 1, 2]
    assert vacuum(spark, root) == [] and len(runs(root, "numbers")) == 2  # it may still be at work
    assert len(vacuum(spark, root, older_than=dt.timedelta(0))) == 1
    assert ids(read_cycle(spark, root, "numbers")) == [0, 1, 2]
    assert ids(write_cycle(spark.range(1), root, "numbers", AS_OF)) == [0]


def test_the_rows_before_stay_readable_and_older_ones_go(spark, tmp_path):
    root = str(tmp_path)
    first = write_cycle(spark.range(1), root, "numbers", AS_OF)
    second = write_cycle(spark.range(2), root, "numbers", AS_OF)
    assert ids(first) == [0]
    write_cycle(spark.range(3), root, "numbers", AS_OF)
    assert ids(second) == [0, 1] and len(runs(root, "numbers")) == 2
    assert first.inputFiles()[0].split("/")[-2] not in runs(root, "numbers")
    # A table that others don't rewrite stays with every commit.
    write_cycle(spark.range(7), root, "kept", AS_OF)
    for n in range(4):
        write_cycle(spark.range(n), root, "numbers", AS_OF)
    assert ids(read_cycle(spark, root, "kept", AS_OF)) == list(range(7))


def test_cycles_are_apart_and_columns_may_change(spark, tmp_path):
    root = str(tmp_path)
    write_cycle(spark.range(3), root, "numbers", AS_OF)
    write_cycle(spark.range(2), root, "numbers", LATER)
    out = write_cycle(spark.range(1).selectExpr("'x' AS word", "id AS Run"), root, "numbers", AS_OF)
    assert out.columns == ["word", "Cycle_Date"] and out.first().Cycle_Date == AS_OF
    assert ids(read_cycle(spark, root, "numbers", LATER)) == [0, 1]
    with pytest.raises(commits.NoSuchCycle):
        read_cycle(spark, root, "numbers", dt.date(2020, 1, 31))
    with pytest.raises(commits.NoSuchCycle):
        read_cycle(spark, root, "nothing")


def test_of_two_runs_one_commits(spark, tmp_path):
    root = str(tmp_path)
    one, two = CycleRun(root, AS_OF), CycleRun(root, AS_OF)
    one(spark.range(1), "numbers")
    two(spark.range(2), "numbers")
    two.commit()
    with pytest.raises(commits.CommitConflict):
        one.commit()
    one.abort()
    assert ids(read_cycle(spark, root, "numbers", AS_OF)) == [0, 1]
    files = commits._Files(spark, root)
    with pytest.raises(commits.CommitConflict, match="exists"):
        commits._publish(files, f"{root}/_commits/{AS_OF}/00000001.json", {})


@pytest.mark.parametrize("fails_at", ["stockout_risk_profile", "kpi_summary", "the pointer"])
def test_a_refresh_is_one_commit(spark, tmp_path, monkeypatch, fails_at):
    root, t = str(tmp_path), tables(spark)
    cycle.refresh(t, AS_OF, cycle.cycle_store(root, AS_OF))
    before = commits.committed_tables(spark, root, AS_OF)
    assert len(before) == 20 and len(set(before.values())) == 1
    report = sorted(map(tuple, read_cycle(spark, root, contracts.REPORT, AS_OF).collect()))

    changed = tables(spark, inventory=[(*r[:4], 10_000, *r[5:]) for r in rows()["inventory"]])
    if fails_at == "the pointer":
        monkeypatch.setattr(commits, "_publish", lambda *a: (_ for _ in ()).throw(OSError("no")))
    store = CycleRun.__call__

    def failing(self, df, name):
        if name == fails_at:
            df = df.withColumn("broken", F.raise_error(F.lit("no")))
        return store(self, df, name)

    monkeypatch.setattr(CycleRun, "__call__", failing)
    with pytest.raises((PySparkException, OSError)):
        cycle.refresh(changed, AS_OF, cycle.cycle_store(root, AS_OF))
    assert commits.committed_tables(spark, root, AS_OF) == before
    assert sorted(map(tuple, read_cycle(spark, root, contracts.REPORT, AS_OF).collect())) == report
    assert all(runs(root, name) == [f"Run={run}"] for name, run in before.items())

    monkeypatch.undo()
    cycle.refresh(changed, AS_OF, cycle.cycle_store(root, AS_OF))
    after = commits.committed_tables(spark, root, AS_OF)
    assert set(after) == set(before) and len(set(after.values())) == 1 and not set(after.values()) & set(before.values())


# --- catalog tables ------------------------------------------------------------------------------------------------


@pytest.fixture
def name(spark):
    yield "replaced_numbers"
    drop_table(spark, "replaced_numbers")


def versions(spark, name):
    return [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}{commits.VERSION}")]


def test_a_table_is_replaced_by_a_query_on_itself(spark, name):
    first = replace_table(spark.range(6), name)
    assert ids(replace_table(spark.table(name).where("id % 2 = 0"), name)) == [0, 2, 4]
    assert ids(first) == list(range(6))  # who had opened it can go on
    assert replace_table(spark.table(name).selectExpr("id * 10 AS tens", "'w' AS word"), name).columns == ["tens", "word"]
    assert sorted(r.tens for r in spark.table(name).collect()) == [0, 20, 40]
    assert len(versions(spark, name)) == 2
    drop_table(spark, name)
    assert versions(spark, name) == [] and not spark.catalog.tableExists(name)


def test_a_failed_replacement_keeps_the_rows(spark, name, monkeypatch):
    replace_table(spark.range(3), name)
    with pytest.raises(PySparkException):
        replace_table(spark.range(9).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")), name)
    assert ids(spark.table(name)) == [0, 1, 2]
    monkeypatch.setattr(commits, "_point", lambda *a: (_ for _ in ()).throw(OSError("no")))
    with pytest.raises(OSError):
        replace_table(spark.range(9), name)
    assert ids(spark.table(name)) == [0, 1, 2] and len(versions(spark, name)) == 1


def test_a_plain_table_becomes_the_first_version(spark, name):
    spark.range(4).write.saveAsTable(name)
    assert ids(replace_table(spark.table(name).where("id > 1"), name)) == [2, 3]
    assert len(versions(spark, name)) == 2
    assert ids(replace_table(spark.range(1), name)) == [0] and len(versions(spark, name)) == 2
    with pytest.raises(AnalysisException):
        spark.range(1).write.mode("errorifexists").saveAsTable(name)
