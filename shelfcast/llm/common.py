"""Helpers shared by the text operators: staged tables, column picking, word arrays, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources.tables import materialise, release, stored_so_far


def staged(df: DataFrame, name: str, since: int | None = None) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back: the lineage ends there, so a lost executor
    costs the stage it ran, and several readers share one computation.

    With ``since``, a mark of `stored_so_far`, tables staged from there on are removed as soon as this one is written:
    for those that nothing but this one reads."""
    until = stored_so_far()
    out = materialise(df, f"llm-{name}")
    if since is not None:
        release(df.sparkSession, since, until)
    return out


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so (Spark ignores letter case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def ascii_words(texts: pa.Array | pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts, flattened, and the offsets of each text in them (null: none)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    kept = np.concatenate([[0], np.cumsum(filled)])
    offsets = kept[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    return flat.filter(pa.array(filled)), offsets


BASE = 0x5851F42D4C957F2D  # of polynomial hashes; odd, so it has an inverse modulo 2^64


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64. With prefix sums of values times powers, the
    difference of two sums times a power of the inverse is the hash of what is between them, wherever it is."""

    def up(base: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        width = 1
        while width < n:  # doubling: the second half is the first times base^width
            more = min(width, n - width)
            out[width : width + more] = out[:more] * np.uint64(pow(base, width, 1 << 64))
            width += more
        return out

    return up(base), up(pow(base, -1, 1 << 64))


def parts(texts: pa.Array, size: int = 2 << 20) -> Iterator[pa.Array]:
    """Slices of a batch of texts that have about ``size`` bytes each, one text at least: what is made of a batch at once
    stays small, however many rows Spark puts into it."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield texts.slice(at, end - at)
        at = end


SIEVE_BITS = 26


def sifted(rows: DataFrame, keys: DataFrame, column: str, flag: str, *, bits: int = SIEVE_BITS) -> DataFrame:
    """Adds ``flag`` to ``rows``: true wherever a row of ``keys`` has the same ``column``, a long hash, and by chance
    for some others; false for the rest, which a join with ``keys`` need not move.

    Keys are kept as one bit each of ``2 ** bits``. So 8 MB are broadcast at most, however many keys there are; more of
    them only let more rows through. Null hashes are false. ``keys`` is read when the result is evaluated.
    """

    def place(of: DataFrame) -> Column:
        return F.pmod(of[column], F.lit(1 << bits)) + 1

    bucket, held = unused(rows, "_bucket"), unused(rows, "_held")
    sieve = keys.groupBy(F.bitmap_bucket_number(place(keys)).alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place(keys))).alias(held)
    )
    at = F.bitmap_bit_position(place(rows)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(held), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = rows.join(F.broadcast(sieve), F.bitmap_bucket_number(place(rows)) == F.col(bucket), "left")
    return met.withColumn(flag, F.coalesce(F.getbit(byte, at % 8) == 1, F.lit(False))).drop(bucket, held)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Label every node of ``edges`` with the smallest node reachable from it: columns ``node`` and ``root``.

    Alternates large-star and small-star steps until nothing changes; each step is aggregations (with map-side partial
    sums) and joins, and is written to the shared folder in place of the one before. A star with very many leaves stays a skewed join, which
    adaptive execution splits. Rounds grow with the logarithm of the longest chain. Null nodes are ignored; no edges
    give no rows.
    """
    mark = stored_so_far()
    links = staged(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links"
    )

    def stars(pairs: DataFrame, larger_only: bool) -> DataFrame:
        # pairs: u > v. The centre of each star hands its (larger, or smaller) neighbours to its smallest one.
        if larger_only:
            both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
            out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            least = pairs.groupBy("u").agg(F.min("v").alias("m"))
            moved = pairs.join(least, "u")
            out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least.select("u", F.col("m").alias("v"))
            )
        return out.where("u <> v").distinct()

    def digest(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    before = digest(links)
    while before[0]:
        links = staged(stars(stars(links, True), False), "links", since=mark)
        after = digest(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
