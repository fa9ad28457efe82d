"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import staged, table

SEED = 17
EXPONENT = 0.7


def uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 over the seed and the keys (null: empty)."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_rates(
    docs: DataFrame, weights: Mapping[str, float] | None = None, *, exponent: float = EXPONENT, volume: float = 1.0
) -> DataFrame:
    """Mean repetitions of a document, per source.

    A source's size is its characters plus one for each document. Its target share is its weight (``weights``; a
    source that is not named has weight 0), or by default its size raised to ``exponent``; the mixture is to have
    ``volume`` times the size of the corpus. Columns ``_source`` (null is a source of its own), ``_rate`` and
    ``_mass``: the cumulative Poisson probabilities at this rate, until they no longer change.
    """
    size = F.sum(F.coalesce(F.length("text"), F.lit(0)) + 1).cast("double")
    sizes = docs.groupBy(F.col("source").alias("_source")).agg(size.alias("_size"))
    if weights is None:
        share = F.pow("_size", F.lit(float(exponent)))
    else:
        share = F.lit(0.0)
        for name, weight in weights.items():
            share = F.when(F.col("_source") == F.lit(name), F.lit(float(weight))).otherwise(share)
    sizes = sizes.withColumn("_share", share)
    totals = sizes.agg(F.sum("_size").alias("_all"), F.sum("_share").alias("_shares"))
    rate = F.when(F.col("_shares") > 0, F.col("_share") / F.col("_shares") * F.col("_all") * volume / F.col("_size"))
    # totals is one row by construction
    rates = sizes.crossJoin(F.broadcast(totals)).select("_source", F.coalesce(rate, F.lit(0.0)).alias("_rate"))
    return rates.withColumn("_mass", cumulative(F.col("_rate")))


def cumulative(rate: Column) -> Column:
    """P(X <= k), k = 0, 1, ... of a Poisson distribution, as far as a 52-bit uniform number can reach.

    Each term is exp(k ln(rate) - rate - ln k!), so that large rates do not underflow; 40 + 14 sqrt(rate) terms past
    the mean leave less than 2^-60.
    """
    last = F.ceil(rate + 14 * F.sqrt(rate) + 40).cast("int")
    log_rate = F.log(F.greatest(rate, F.lit(1e-300)))
    step = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(
            F.lit(0.0).alias("log_factorial"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("all")
        ),
        lambda acc, k: F.struct(
            (acc["log_factorial"] + F.log(k.cast("double"))).alias("log_factorial"),
            (acc["sum"] + F.exp(k * log_rate - rate - (acc["log_factorial"] + F.log(k.cast("double"))))).alias("sum"),
            F.concat(
                acc["all"],
                F.array(acc["sum"] + F.exp(k * log_rate - rate - (acc["log_factorial"] + F.log(k.cast("double"))))),
            ).alias("all"),
        ),
        lambda acc: acc["all"],
    )
    return F.when(rate > 0, step).otherwise(F.array(F.lit(1.0)))


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    *,
    seed: int = SEED,
    exponent: float = EXPONENT,
    volume: float = 1.0,
) -> DataFrame:
    """The corpus with each document repeated a Poisson number of times, so that sources reach their target shares,
    in a global random order.

    ``docs`` has ``doc_id, text, source``; all its columns are returned, plus ``copy`` (0, 1, ...) and ``mix_key`` (the
    random order key); input columns of these two names are replaced, and columns of the operator's own temporary names
    (leading underscore) are dropped. The number of copies inverts the distribution at a uniform number hashed from
    seed, doc_id, text and source, so it is the same wherever the row is and however often it is computed. Rows equal in
    these three get equal counts. Null text has size 0, null source is a source of its own, an empty table gives no rows.

    The shuffle sends each copy to a partition by its random key, its text and its source, so no source and no group of copies
    can gather in one, except that equal rows share a partition for each copy number; only one row per source is joined to the documents.
    """
    own = {"copy", "mix_key", "_source", "_rate", "_mass", "_copies", "_place"}
    docs = docs.drop(*own & set(docs.columns))
    columns = docs.columns
    # Stored, so that Spark knows its size: a few sources are broadcast, very many are joined by key.
    rates = staged(source_rates(docs, weights, exponent=exponent, volume=volume), "rates")
    joined = docs.join(rates, F.col("source").eqNullSafe(F.col("_source")), "left")
    draw = uniform(seed, F.col("doc_id"), F.md5(F.coalesce("text", F.lit(""))), F.col("source"))
    # Counted inside a lambda, so that the draw is computed once and not for every mass it is compared with; the last
    # mass may round to just below 1, a draw beyond it gets the last count.
    count = F.transform(
        F.array(draw), lambda u: F.size(F.filter("_mass", lambda p: (p <= u) & (p < 1.0)))
    )
    counted = joined.withColumn("_copies", F.when(F.col("_rate") > 0, F.element_at(count, 1)).otherwise(0))
    copies = counted.where("_copies > 0").select(
        *columns, F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("copy")
    )
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("order"), F.col("doc_id").cast("string"), F.col("copy")))
    keyed = copies.withColumn("mix_key", key)
    # Rows without id, or of one id, share a key: their text and source tell them apart.
    place = F.xxhash64("mix_key", "text", "source")
    return keyed.withColumn("_place", place).repartition("_place").sortWithinPartitions("mix_key", "_place").drop("_place")


def op1_mix(spark: SparkSession, root: str) -> DataFrame:
    return mix(table(spark, root, "documents"))


def stage(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    """Pipeline stage: the repeated documents in their global order, with the columns of the input."""
    return mix(docs).select(*docs.columns)


_U = "('0x' || substr(md5({}), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0"

OP1_SQL = f"""
WITH sizes AS (
  SELECT source, sum(coalesce(length(text), 0) + 1)::DOUBLE AS size FROM documents GROUP BY source
), shares AS (
  SELECT source, size, pow(size, {EXPONENT}) AS share FROM sizes
), rates AS (
  SELECT source, share / sum(share) OVER () * sum(size) OVER () / size AS rate FROM shares
), terms AS (
  SELECT source, rate, k, exp(k * ln(rate) - rate - coalesce(sum(ln(greatest(k, 1))) OVER w, 0)) AS p
  FROM rates, range(0, 200) t(k) WINDOW w AS (PARTITION BY source ORDER BY k)
), mass AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS mass FROM terms
), drawn AS (
  SELECT *, {_U.format(f"'{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || ':' || coalesce(source, '')")} AS u
  FROM documents
), counts AS (
  SELECT any_value(d.doc_id) AS doc_id, any_value(d.text) AS text, any_value(d.lang) AS lang,
         any_value(d.source) AS source, any_value(d.n_chars) AS n_chars, count(*) FILTER (m.mass <= d.u) AS copies
  FROM (SELECT *, row_number() OVER () AS r FROM drawn) d
  JOIN mass m ON m.source IS NOT DISTINCT FROM d.source GROUP BY d.r
), copied AS (
  SELECT doc_id, text, lang, source, n_chars, unnest(range(0, copies))::INTEGER AS copy FROM counts
)
SELECT *, md5('{SEED}:order:' || doc_id || ':' || copy) AS mix_key FROM copied
"""
