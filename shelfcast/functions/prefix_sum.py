"""Running totals and ranks over a whole DataFrame, without sending it through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.sources.tables import materialise


def _in_buckets(df: DataFrame, order: Sequence[Column], buckets: int | None) -> DataFrame:
    """The rows cut into contiguous buckets (``_bucket``) of similar size along ``order``, stored.

    An unpartitioned window would sort every row in one task. A range partitioning along the full sort key cuts a value
    shared by most rows as well, along the columns that break ties. The bucketed rows are stored once, because the cut
    points come from a sample and a second evaluation could cut elsewhere. ``df`` is evaluated here and now.
    """
    ranged = df.repartitionByRange(*order) if buckets is None else df.repartitionByRange(buckets, *order)
    return materialise(ranged.withColumn("_bucket", F.spark_partition_id()), "in_buckets")


def _before(totals: DataFrame, own: Column) -> Column:
    """The sum of ``own`` over all earlier buckets. One row per bucket, and buckets are as many as shuffle partitions."""
    through_here = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(own).over(through_here) - own


def running_total(
    df: DataFrame,
    value: str,
    tie_break: Sequence[str],
    *,
    running: str,
    total: str,
    buckets: int | None = None,
) -> DataFrame:
    """Add the running total of ``value`` over all rows, largest first, and the grand total.

    Equal values are ordered by ``tie_break``, which has to tell all rows apart; missing values come last and count
    as zero. Each bucket is summed on its own and shifted by the total of the buckets before it; only the bucket totals
    meet in one task and are broadcast. ``buckets`` is the number of them at most (default: the session's shuffle
    partitions, where AQE merges small ones).
    """
    order = [F.desc_nulls_last(value), *[F.asc_nulls_first(name) for name in tie_break]]
    bucketed = _in_buckets(df, order, buckets)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.coalesce("_own", F.lit(0))
    totals = bucketed.groupBy("_bucket").agg(F.sum(value).alias("_own"))
    offsets = totals.select("_bucket", _before(totals, own).alias("_before"), F.sum(own).over(everything).alias(total))

    inside = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        bucketed.withColumn(running, F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(running, F.col(running) + F.col("_before"))
        .drop("_bucket", "_before")
    )


def with_rank(
    df: DataFrame, by: str, tie_break: Sequence[str], *, ascending: bool = False, name: str = "Rank", buckets: int | None = None
) -> DataFrame:
    """Number all rows 1, 2, ... by ``by`` (missing values last) and then ``tie_break``.

    The number makes the order part of a stored table, which keeps none.
    """
    first = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    order = [first, *[F.asc_nulls_first(column) for column in tie_break]]
    bucketed = _in_buckets(df, order, buckets)
    totals = bucketed.groupBy("_bucket").agg(F.count("*").alias("_own"))
    offsets = totals.select("_bucket", _before(totals, F.col("_own")).alias("_before"))
    inside = Window.partitionBy("_bucket").orderBy(*order)
    return (
        bucketed.withColumn(name, F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col(name) + F.col("_before"))
        .drop("_bucket", "_before")
    )
