"""Summaries that merge: stored once per group, later combined into coarser groups without reading the rows again."""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import all_of

LG_K = 14  # 2^14 registers: a standard deviation of 0.8 %
DISTINCT_BOUND = 0.04  # five of them
ACCURACY = 0.01


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str], *, lg_k: int = LG_K) -> DataFrame:
    """``by`` and ``Sketch``: a sketch of the distinct tuples of ``columns`` per group, of at most 2^lg_k registers.

    Rows with a NULL in ``columns`` do not count, like in an exact distinct count; a group of such rows only has an empty sketch. One sketch per
    task and group is shuffled, however many values there are.
    """
    complete = all_of(F.col(c).isNotNull() for c in columns)
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.when(complete, F.xxhash64(*columns)), lg_k).alias("Sketch"))


def merged_distinct(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by`` and ``Approx_Distinct`` from stored sketches: values that several of them hold count once.

    ``by`` are columns of the stored table, or none for one row over all. The estimate is within ``DISTINCT_BOUND`` of the
    exact count at five standard deviations, and nearly exact for counts far below the number of registers.
    """
    united = sketches.groupBy(*by).agg(F.hll_union_agg("Sketch").alias("Sketch"))
    return united.select(*by, F.coalesce(F.hll_sketch_estimate("Sketch"), F.lit(0)).alias("Approx_Distinct"))


def _gamma(accuracy: float) -> float:
    return (1 + accuracy) / (1 - accuracy)


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str], *, accuracy: float = ACCURACY) -> DataFrame:
    """``by, Bucket, Bucket_Rows``: how many values of a group fall into each bucket, NULLs left out.

    Buckets grow by a constant factor, so that a bucket's middle is within ``accuracy`` (relative) of each value in it; zero has
    bucket 0, negative values have buckets of their own. Their number grows with the logarithm of the range: 1,400 buckets span
    from one to 10^12. They are counted with partial sums before the shuffle: a hot group costs one row per task and bucket.
    """
    x = F.col(value).cast("double")
    # Shifted by a number beyond all exponents of a double, so that the sign is free for the sign of the value.
    size = F.ceil(F.log(F.abs(x)) / F.lit(math.log(_gamma(accuracy)))) + F.lit(_shift(accuracy))
    bucket = F.when(x == 0, F.lit(0)).when(x > 0, size).otherwise(-size).cast("long")
    return df.where(x.isNotNull()).groupBy(*by, bucket.alias("Bucket")).agg(F.count("*").alias("Bucket_Rows"))


def _shift(accuracy: float) -> int:
    return math.ceil(1100 * math.log(2) / math.log(_gamma(accuracy)))


def merged_quantile(sketches: DataFrame, quantiles: Sequence[float], by: Sequence[str] = (), *, accuracy: float = ACCURACY) -> DataFrame:
    """``by`` and an array ``Quantiles`` from stored sketches of the same ``accuracy``: for each share q the value whose
    rank is the first to reach q, within ``accuracy`` of it.

    A window group holds the buckets of a group, not its rows.
    """
    merged = sketches.groupBy(*by, "Bucket").agg(F.sum("Bucket_Rows").alias("n"))
    through = Window.partitionBy(*by).orderBy("Bucket")
    group = Window.partitionBy(*by)
    ranked = merged.withColumns({"through": F.sum("n").over(through), "all": F.sum("n").over(group)})
    middle = _middle(F.col("Bucket"), accuracy)
    found = [F.min(F.when(_reached(q), F.struct("Bucket", middle.alias("v")))) for q in quantiles]
    return ranked.groupBy(*by).agg(F.array(*[f["v"] for f in found]).alias("Quantiles"))


def _reached(q: float) -> Column:
    """The running number has come to the share ``q`` of all rows; as a decimal, since 0.1 * 30 is not 3 in binary."""
    return F.col("through") >= F.greatest(F.ceil(F.col("all") * F.lit(Decimal(str(q)))), F.lit(1))


def _middle(bucket: Column, accuracy: float) -> Column:
    gamma, exponent = _gamma(accuracy), F.abs(bucket) - F.lit(_shift(accuracy))
    return F.signum(bucket.cast("double")) * 2 * F.pow(F.lit(gamma), exponent.cast("double")) / (gamma + 1)


def exact_quantile(df: DataFrame, value: str, quantiles: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by`` and an array ``Quantiles``, by the same definition and exactly.

    Values are counted first, with partial sums: what meets in one task is the group's different values and their
    running numbers, sorted outside of memory if need be, and not a map of them as in ``percentile_disc``.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("v")).agg(F.count("*").alias("n"))
    through = Window.partitionBy(*by).orderBy("v")
    ranked = counted.withColumns({"through": F.sum("n").over(through), "all": F.sum("n").over(Window.partitionBy(*by))})
    found = [F.min(F.when(_reached(q), F.col("v"))) for q in quantiles]
    return ranked.groupBy(*by).agg(F.array(*found).alias("Quantiles"))
