"""The distributed running total against a plain loop over sorted rows."""

from __future__ import annotations

import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.functions import prefix_sum
from shelfcast.functions.prefix_sum import running_total
from shelfcast.operators.drivers import pareto_priority, shortfall_pareto
from shelfcast.sources.tables import materialise

SCHEMA = "Material_ID string, Site_ID string, units bigint"


def expected(rows):
    ordered = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0], r[1] is not None, r[1] or ""))
    sums = itertools.accumulate(r[2] or 0 for r in ordered)
    return {(r[0], r[1]): total for r, total in zip(ordered, sums, strict=True)}


def actual(spark, rows, buckets):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    result = running_total(df, "units", ["Material_ID", "Site_ID"], running="running", total="total", buckets=buckets).collect()
    totals = {row.total for row in result}
    return {(row.Material_ID, row.Site_ID): row.running for row in result}, totals


CASES = {
    "distinct": [(f"M{i:03}", "S", i) for i in range(500)],
    "one value": [(f"M{i:03}", "S", 7) for i in range(500)],
    "a third equal": [(f"M{i:03}", "S", 3 if i % 3 else i) for i in range(500)],
    "heavy tail": [(f"M{i:03}", "S", 2 ** (i % 50)) for i in range(500)],
    "zeros": [(f"M{i:03}", "S", 0) for i in range(50)],
    "missing": [(f"M{i:03}", None if i % 2 else "S", None if i % 5 == 0 else i) for i in range(50)],
    "single": [("M", "S", 5)],
}


@pytest.mark.parametrize("rows", CASES.values(), ids=CASES.keys())
@pytest.mark.parametrize("buckets", [None, 1, 7, 64])
def test_equals_sequential_sum(spark, rows, buckets):
    got, totals = actual(spark, rows, buckets)
    assert got == expected(rows)
    assert totals == {sum(r[2] or 0 for r in rows)}


def test_no_rows(spark):
    assert actual(spark, [], 8) == ({}, set())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    units=st.lists(st.one_of(st.none(), st.integers(0, 20), st.integers(0, 10**12)), min_size=1, max_size=60),
    buckets=st.integers(1, 40),
)
def test_any_values(spark, units, buckets):
    rows = [(f"M{i % 40:02}", f"S{i // 40}", value) for i, value in enumerate(units)]
    got, _ = actual(spark, rows, buckets)
    assert got == expected(rows)


def test_a_value_shared_by_most_rows_is_spread_over_buckets(spark, monkeypatch):
    """Half of the rows are equal; still no bucket holds much more than its share of the rows."""
    stored = []

    def keep(df, name):
        stored.append(materialise(df, name))
        return stored[-1]

    monkeypatch.setattr(prefix_sum, "materialise", keep)
    n, buckets = 20_000, 16
    df = spark.range(n, numPartitions=8).select(
        F.format_string("M%06d", "id").alias("Material_ID"),
        F.lit("S").alias("Site_ID"),
        F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("units"),
    )
    running_total(df, "units", ["Material_ID", "Site_ID"], running="running", total="total", buckets=buckets)
    sizes = [row["count"] for row in stored[0].groupBy("_bucket").count().collect()]
    assert sum(sizes) == n
    assert len(sizes) == buckets
    assert max(sizes) < 2 * n / buckets


def test_no_task_sees_all_rows(spark):
    """The only unpartitioned window works on bucket totals, and nothing is joined without a key."""
    df = spark.createDataFrame(CASES["distinct"], SCHEMA)
    result = running_total(df, "units", ["Material_ID", "Site_ID"], running="running", total="total", buckets=8)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    below_single = plan.split("Exchange SinglePartition")[1:]
    assert len(below_single) == 1
    project, aggregate = below_single[0].splitlines()[1:3]
    assert "Project" in project and "HashAggregate(keys=[_bucket" in aggregate


def test_zero_total_gives_unknown_shares(spark):
    coverage = spark.createDataFrame([("A", "S", 0), ("B", "S", 0)], "Material_ID string, Site_ID string, Remaining_Shortfall_Units bigint")
    pareto = shortfall_pareto(coverage)
    assert {(r.Shortfall_Share_Pct, r.Cumulative_Shortfall_Pct) for r in pareto.collect()} == {(None, None)}
    assert pareto_priority(pareto).count() == 0
