"""Sketches that merge, against exact results."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import sketches
from shelfcast.operators import scenarios


def plain_quantile(values, q):
    values = sorted(v for v in values if v is not None)
    return values[max(1, math.ceil(round(len(values) * q, 9))) - 1] if values else None


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(9)
    rows = [("hot", i % 12, float(rng.choice([1, 2, 3, int(rng.lognormvariate(6, 3))])), i % 7000) for i in range(20_000)]
    rows += [(f"g{i % 5}", i % 12, rng.choice([None, 0.0, -rng.expovariate(0.01), rng.expovariate(1e-6)]), rng.choice([None, i])) for i in range(2000)]
    rows += [("single", 0, 7.0, 1), ("nothing", 3, None, None), (None, 1, -2.5, 5)]
    return rows, spark.createDataFrame(rows, "grp string, month int, value double, item int").repartition(6).cache()


QUANTILES = [0.0, 0.1, 0.5, 0.9, 1.0]


def test_merged_quantiles_keep_their_accuracy_on_a_skewed_group(spark, skewed):
    rows, df = skewed
    stored = sketches.quantile_sketches(df, "value", ["grp", "month"])
    found = {r.grp: r.Quantiles for r in sketches.merged_quantile(stored, QUANTILES, ["grp"]).collect()}
    exact = {r.grp: r.Quantiles for r in sketches.exact_quantile(df, "value", QUANTILES, ["grp"]).collect()}
    assert set(found) == set(exact) == {r[0] for r in rows} - {"nothing"}
    for group in found:
        values = [r[2] for r in rows if r[0] == group]
        assert exact[group] == [plain_quantile(values, q) for q in QUANTILES]
        for a, e in zip(found[group], exact[group]):
            assert abs(a - e) <= 1.000001 * sketches.ACCURACY * abs(e)
    whole = sketches.merged_quantile(stored, [0.5]).first().Quantiles[0]
    assert whole == pytest.approx(plain_quantile([r[2] for r in rows], 0.5), rel=1.001 * sketches.ACCURACY)


def test_merging_gives_what_one_sketch_would(skewed):
    _, df = skewed
    by_month = sketches.quantile_sketches(df, "value", ["grp", "month"]).groupBy("grp", "Bucket").agg(F.sum("Bucket_Rows").alias("Bucket_Rows"))
    at_once = sketches.quantile_sketches(df, "value", ["grp"])
    assert by_month.exceptAll(at_once).count() == at_once.exceptAll(by_month).count() == 0
    assert at_once.where("grp = 'hot'").count() < 1500  # not one per value


def test_merged_distinct_counts_keep_their_bound(skewed):
    rows, df = skewed
    stored = sketches.distinct_sketches(df, ["grp", "item"], ["month"])
    assert stored.count() == 12
    exact = len({(r[0], r[3]) for r in rows if r[0] is not None and r[3] is not None})
    found = sketches.merged_distinct(stored).first().Approx_Distinct
    assert abs(found - exact) <= sketches.DISTINCT_BOUND * exact
    per_month = {r.month: r.Approx_Distinct for r in sketches.merged_distinct(stored, ["month"]).collect()}
    for month, n in per_month.items():
        exact = len({(r[0], r[3]) for r in rows if r[1] == month and r[0] is not None and r[3] is not None})
        assert abs(n - exact) <= sketches.DISTINCT_BOUND * exact


def test_empty_and_missing(spark):
    empty = spark.createDataFrame([], "grp string, month int, value double, item int")
    assert sketches.merged_distinct(sketches.distinct_sketches(empty, ["item"], ["grp"]), ["grp"]).collect() == []
    assert sketches.merged_quantile(sketches.quantile_sketches(empty, "value", ["grp"]), [0.5], ["grp"]).collect() == []
    nulls = spark.createDataFrame([("a", 1, None, None)], empty.schema)
    assert sketches.merged_distinct(sketches.distinct_sketches(nulls, ["item"], ["grp"]), ["grp"]).first().Approx_Distinct == 0


def test_top_rows_are_taken_without_a_full_sort(spark, skewed):
    _, df = skewed
    top = scenarios.ranked(df, "value", ties=["grp", "item"], top=3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan.replace("RoundRobin", "")[: plan.find("InMemory")]
    assert [r.value for r in top.collect()] == sorted((r.value for r in df.collect() if r.value is not None), reverse=True)[:3]
