"""Near-duplicates: SimHash fingerprints linked at a few differing bits, found with vantage-point trees."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shelfcast.llm.common import connected_components, staged, table, unused
from shelfcast.sources.tables import stored_so_far

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
SHARD_POINTS = 8192  # distinct fingerprints that live in a shard, about
SAMPLE_POINTS = 1 << 16  # at most so many fingerprints choose the vantage points of the shards
LEAF_POINTS = 48  # inside a shard, so few are compared without another split
HASH_BLOCK = 1 << 15


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a whole text: each bit is set if it is in over half of the shingles' XXH64 hashes.

    Null and empty texts, and texts of white space, have fingerprint 0; fewer words than a shingle make one shingle.
    """
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(parts) - words + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, HASH_BLOCK):
        some = zip(starts[at : at + HASH_BLOCK], ends[at : at + HASH_BLOCK])
        hashes = np.fromiter((digest(joined[i:j], HASH_SEED) for i, j in some), "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(words: int) -> Callable:
    @arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = np.array([fingerprint(t.as_py(), words) for t in texts], np.uint64)
            yield pa.array(found.view(np.int64))

    return of


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def split(points: np.ndarray) -> tuple[np.uint64, int, np.ndarray] | None:
    """A vantage point and a radius that halve the points by distance, and the distances; None if none can.

    Of a few candidates the one with the widest spread of distances is taken: fewer points lie at the boundary.
    """
    best = None
    for candidate in points[np.linspace(0, len(points) - 1, 6).astype(int)]:
        distance = distances(points, candidate)
        radius = int(np.partition(distance, (len(points) - 1) // 2)[(len(points) - 1) // 2])
        if radius >= distance.max():
            radius = int(distance.max()) - 1
        if radius < distance.min():
            continue
        spread = float(distance.std())
        if best is None or spread > best[0]:
            best = (spread, candidate, radius, distance)
    return best[1:] if best else None


def shard_tree(sample: np.ndarray, shards: int) -> list[tuple[int, int, int, int]]:
    """The upper levels of a vantage-point tree: nodes (vantage, radius, inner child, outer child); a child -1 - s is
    shard s. A sample that cannot be halved further stays one shard."""
    nodes: list[tuple[int, int, int, int]] = []
    leaves = 0

    def grow(points: np.ndarray, want: int) -> int:
        nonlocal leaves
        cut = split(points) if want > 1 and len(points) > 1 else None
        if cut is None:
            leaves += 1
            return -leaves
        vantage, radius, distance = cut
        at = len(nodes)
        nodes.append((0, 0, 0, 0))
        inner = grow(points[distance <= radius], want // 2)
        outer = grow(points[distance > radius], want - want // 2)
        nodes[at] = (int(vantage), radius, inner, outer)
        return at

    grow(sample, shards)
    return nodes


def route(nodes: list[tuple[int, int, int, int]], points: np.ndarray, reach: int) -> tuple[np.ndarray, ...]:
    """Where each point lives (its home shard) and which other shards may hold points within ``reach`` of it.

    By the triangle inequality a neighbour's distance to a vantage point differs by at most ``reach``, so only branches
    whose boundary is that near are followed. Returns rows (shard, index of the point, at home).
    """
    rows: list[tuple[int, np.ndarray, np.ndarray]] = []
    todo = [(0 if nodes else -1, np.arange(len(points)), np.ones(len(points), bool))]
    while todo:
        at, index, home = todo.pop()
        if not len(index):
            continue
        if at < 0:
            rows.append((-1 - at, index, home))
            continue
        vantage, radius, inner, outer = nodes[at]
        distance = distances(points[index], np.uint64(vantage))
        near, far = distance <= radius + reach, distance > radius - reach
        todo.append((inner, index[near], (home & (distance <= radius))[near]))
        todo.append((outer, index[far], (home & (distance > radius))[far]))
    shard = np.concatenate([np.full(len(i), s, np.int32) for s, i, _ in rows] or [np.zeros(0, np.int32)])
    index = np.concatenate([i for _, i, _ in rows] or [np.zeros(0, np.int64)])
    return shard, index, np.concatenate([h for _, _, h in rows] or [np.zeros(0, bool)])


def labels_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 the smallest node of their component under the links (a[i], b[i])."""
    label = np.arange(n)
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        open_ = low < high
        if not open_.any():
            return label
        np.minimum.at(label, high[open_], low[open_])
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped


def search(points: np.ndarray, home: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the points at home and all points (indices into ``points``) that connect exactly the pairs
    within ``reach``: a vantage-point tree over the points at home, walked by all queries of a branch together.

    At a leaf a query is linked to its first match, and that one to the query's other matches, so a dense leaf makes
    links in proportion to its points, not to their pairs.
    """
    found_a, found_b = [], []
    todo = [(np.flatnonzero(home), np.arange(len(points)))]
    while todo:
        inside, queries = todo.pop()
        if not len(inside) or not len(queries):
            continue
        cut = split(points[inside]) if len(inside) > LEAF_POINTS else None
        if cut is not None:
            vantage, radius, distance = cut
            to_query = distances(points[queries], vantage)
            todo.append((inside[distance <= radius], queries[to_query <= radius + reach]))
            todo.append((inside[distance > radius], queries[to_query > radius - reach]))
            continue
        for block in np.array_split(inside, -(-len(inside) // LEAF_POINTS)):
            for at in range(0, len(queries), 1 << 16):
                some = queries[at : at + (1 << 16)]
                close = np.bitwise_count(points[block][:, None] ^ points[some][None, :]) <= reach
                hit = close.any(axis=0)
                if not hit.any():
                    continue
                close, some = close[:, hit], some[hit]
                first = close.argmax(axis=0)
                found_a.append(some)
                found_b.append(block[first])
                other, which = np.nonzero(close)
                pair = np.unique(first[which] * len(block) + other)
                found_a.append(block[pair // len(block)])
                found_b.append(block[pair % len(block)])
        if len(found_a) > 256:
            label = labels_of(len(points), np.concatenate(found_a), np.concatenate(found_b))
            moved = np.flatnonzero(label != np.arange(len(points)))
            found_a, found_b = [moved], [label[moved]]
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(found_a or empty), np.concatenate(found_b or empty)


def link_fingerprints(points: DataFrame, reach: int, *, shard_points: int, sample_points: int) -> DataFrame:
    """Links ``a, b`` between the distinct fingerprints of the column ``fp`` whose graph has the same components as that
    of all pairs within ``reach`` bits.

    The vantage points of the shards come from a sample of bounded size (an index; every fingerprint is compared); every fingerprint is then routed to its home shard and
    to the shards its ball overlaps, and each shard is searched exactly. A shard returns a link per point, not pairs.
    """
    count = points.count()
    shards = min(-(-count // shard_points), sample_points // 16)
    # One of so many fingerprints by hash: about ``sample_points`` of them, whatever the number of partitions.
    one_of = -(-count // sample_points) if shards > 1 else count + 1
    taken = points.where(F.pmod(F.xxhash64("fp"), F.lit(one_of)) == 0).select("fp").toPandas()["fp"]
    nodes = shard_tree(np.sort(taken.to_numpy(np.int64)).view(np.uint64), max(1, shards))

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fp"].to_numpy(np.int64)
            shard, index, home = route(nodes, values.view(np.uint64), reach)
            yield pd.DataFrame({"shard": shard, "fp": values[index], "home": home})

    def linked(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("fp", ignore_index=True)
        values = shard["fp"].to_numpy(np.int64)
        a, b = search(values.view(np.uint64), shard["home"].to_numpy(bool), reach)
        label = labels_of(len(values), a, b)
        moved = label != np.arange(len(values))
        return pd.DataFrame({"a": values[moved], "b": values[label[moved]]})

    visits = staged(points.select("fp").mapInPandas(routed, "shard int, fp long, home boolean"), "visits")
    return _cells(visits, shard_points).groupBy("shard", "part", "block").applyInPandas(linked, "a long, b long")


def _cells(visits: DataFrame, shard_points: int) -> DataFrame:
    """``visits`` with ``part`` and ``block``: a shard that holds more than it should is searched in cells.

    Its home points are dealt to parts, all its points to blocks, and each cell compares a part with a block, so every home
    point still meets every point of the shard, and no group has more than about 20 times ``shard_points`` rows. A usual shard is one cell.
    """
    sizes = visits.groupBy("shard").agg(
        F.ceil(F.count_if("home") / (4 * shard_points)).alias("parts"), F.ceil(F.count("*") / (16 * shard_points)).alias("blocks")
    )
    part = F.pmod(F.xxhash64("fp"), F.greatest("parts", F.lit(1)))
    block = F.pmod(F.xxhash64(F.lit(1), "fp"), F.greatest("blocks", F.lit(1)))
    as_query = F.transform(F.sequence(F.lit(0), F.greatest("parts", F.lit(1)) - 1), lambda p: F.struct(p.cast("long").alias("part"), block.alias("block")))
    at_home = F.transform(F.sequence(F.lit(0), F.greatest("blocks", F.lit(1)) - 1), lambda b: F.struct(part.alias("part"), b.cast("long").alias("block")))
    cells = F.when(F.col("home"), F.array_union(as_query, at_home)).otherwise(as_query)
    dealt = visits.join(sizes, "shard").select("shard", "fp", "home", part.alias("own"), F.explode(cells).alias("cell"))
    home = F.col("home") & (F.col("own") == F.col("cell.part"))
    return dealt.select("shard", "fp", home.alias("home"), "cell.part", "cell.block")


def near_duplicates(
    docs: DataFrame,
    *,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    shard_points: int = SHARD_POINTS,
    sample_points: int = SAMPLE_POINTS,
    carried: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``; other columns are ignored): ``doc_id``, ``fingerprint`` (16 hex
    digits), ``component_id`` (the smallest doc_id reachable over links of at most ``max_bits`` differing bits),
    ``component_fp`` (its smallest fingerprint, as a signed number) and the ``carried`` columns of the row.

    Null and empty texts share fingerprint zero, which links like any other. Equal rows stay separate rows of one
    component. Rows without doc_id take part but name no component; a component of such rows only has a null id. An
    empty table gives no rows.

    Work and memory: copies are reduced to distinct fingerprints before anything is compared; a shard holds about
    ``shard_points`` of them and its visitors, and one that holds more, since its points cannot be told apart by
    distance or there are more than the sample can halve, is searched in cells; the sample of ``sample_points`` is all the driver sees. Joins back are on
    the fingerprint, plain equi-joins in which adaptive execution splits a hot one.
    """
    prints = staged(
        docs.select("doc_id", *carried, _fingerprints(shingle_words)(F.col("text").cast("string")).alias("fp")),
        "fingerprints",
    )
    points = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    mark = stored_so_far()
    links = link_fingerprints(points, max_bits, shard_points=shard_points, sample_points=sample_points)
    labels = staged(connected_components(links), "labels", since=mark)
    ids = (
        points.join(labels, points["fp"] == labels["node"])
        .groupBy("root")
        .agg(F.min("least").alias("component_id"))
        .join(labels, "root")
        .select("node", "root", "component_id")
    )
    named = points.join(ids, points["fp"] == ids["node"], "left").select(
        "fp",
        F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("root", "fp").alias("component_fp"),
    )
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_fp", *carried
    )


def op4_simhash(spark: SparkSession, root: str) -> DataFrame:
    return near_duplicates(table(spark, root, "documents")).select("doc_id", "fingerprint", "component_id")


def stage(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    """Pipeline stage: one row of each component, that with the smallest id (without id: last).

    Rows are told apart by id and text: unlike texts under one id are in components of their own, and one row of each
    stays; of texts alike under one id it is the one with the smaller hash, whatever the partitioning.
    """
    mark = stored_so_far()
    one, two = unused(docs, "_row"), unused(docs, "_text")
    named = docs.withColumns({one: F.xxhash64("doc_id", "text"), two: F.xxhash64(F.lit(1), "text", "doc_id")})
    found = near_duplicates(named, carried=[one, two])
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", one, two)).alias("first")
    keep = found.groupBy("component_fp").agg(first).select(f"first.{one}", f"first.{two}")
    return named.join(staged(keep, "kept", since=mark), [one, two], "left_semi").dropDuplicates([one, two]).select(*docs.columns)
