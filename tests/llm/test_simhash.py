import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfcast.llm import simhash


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, reach=2):
    points = sorted(set(prints))
    parent = {p: p for p in points}

    def top(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(points):
        for b in points[:i]:
            if (a ^ b).bit_count() <= reach:
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {p: top(p) for p in points}


def expected(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = plain_components(prints)
    least = {}
    for (doc, _), p in zip(rows, prints):
        known = [x for x in (least.get(root[p]), doc) if x is not None]
        least[root[p]] = min(known) if known else None
    return sorted(((d, f"{p:016x}", least[root[p]]) for (d, _), p in zip(rows, prints)), key=repr)


def result(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit("clash")).withColumn("node", F.lit(1))
    out = simhash.near_duplicates(docs, **options).select("doc_id", "fingerprint", "component_id")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_against_brute_force_with_copies_nulls_and_ties(spark):
    rng = random.Random(3)
    words = ["Ärger", "the", "OF", "and", "river", "stone", "x", " ", "cold"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 9)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (None, None), (None, "the river"), (3, rows[3][1]), (3, rows[3][1])]
    rows += [(300, "word " * 50_000)]
    assert result(spark, rows, shard_points=8) == expected(rows)


def test_empty_table(spark):
    assert result(spark, []) == []


@pytest.mark.parametrize("seed", range(4))
def test_tree_finds_every_near_pair(seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    points = np.repeat(centres, 30)
    for _ in range(4):
        flip = rng.random(len(points)) < 0.7
        points = np.where(flip, points ^ (np.uint64(1) << rng.integers(0, 64, len(points), dtype=np.uint64)), points)
    points = np.unique(points)
    nodes = simhash.shard_tree(points[::3], 9)
    shard, index, home = simhash.route(nodes, points, 2)
    assert np.bincount(index[home], minlength=len(points)).tolist() == [1] * len(points)
    links_a, links_b = [], []
    for s in np.unique(shard):
        here = index[shard == s]
        a, b = simhash.search(points[here], home[shard == s], 2)
        links_a.append(here[a])
        links_b.append(here[b])
    a, b = np.concatenate(links_a), np.concatenate(links_b)
    label = simhash.labels_of(len(points), a, b)
    close = np.bitwise_count(points[:, None] ^ points[None, :]) <= 2
    x, y = np.nonzero(close)
    assert label.tolist() == simhash.labels_of(len(points), x, y).tolist()


def test_stage_keeps_one_of_each_group(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text), (4, text), (4, text), (9, "quite another text about other things"), (None, text), (None, "alone here now"), (None, "alone here now")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = simhash.stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()) == [(4, text), (9, "quite another text about other things")]
    assert [r.text for r in kept.where("doc_id is null").collect()] == ["alone here now"]


def test_parts_of_a_batch_are_bounded_and_complete():
    import pyarrow as pa

    from shelfcast.llm.common import parts

    texts = pa.array(["ab", None, "c" * 50, "", "de", "f"] * 3)
    cut = list(parts(texts, 4))
    assert [t for p in cut for t in p.to_pylist()] == texts.to_pylist()
    assert all(len(p) == 1 or sum(len(t or "") for t in p.to_pylist()) <= 4 for p in cut)
    assert list(parts(texts.slice(0, 0), 4)) == []


@pytest.mark.parametrize("shard_points", [2, 40])
def test_dense_clusters_are_searched_in_cells(spark, shard_points):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 3, dtype=np.uint64)
    points = {int(b) for b in base}
    for b in base.tolist():  # a ball around each, and chains that leave it
        points |= {b ^ 1 << i ^ 1 << j for i in range(24) for j in range(i)}
        points |= {b ^ (1 << 30) - 1 ^ 1 << i for i in range(40)}
    points = sorted(points)
    signed = np.array(points, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(5)
    links = simhash.link_fingerprints(frame, 2, shard_points=shard_points, sample_points=64).collect()
    place = {p: i for i, p in enumerate(signed)}
    label = simhash.labels_of(len(points), np.array([place[r.a] for r in links]), np.array([place[r.b] for r in links]))
    expected = plain_components(points)
    roots = {}
    assert all(roots.setdefault(l, expected[p]) == expected[p] for p, l in zip(points, label.tolist()))
    assert len(set(roots.values())) == len(roots) > 1


def test_cells_are_bounded_and_complete(spark):
    rows = [(s, i, i % 3 > 0) for s, n in ((0, 5), (1, 3000), (2, 1)) for i in range(n)]
    cells = simhash._cells(spark.createDataFrame(rows, "shard int, fp long, home boolean"), 10).toPandas()
    sizes = cells.groupby(["shard", "part", "block"]).size()
    assert sizes[0].tolist() == [5] and sizes[2].tolist() == [1] and sizes[1].max() < 20 * 10 * 1.5
    mine = cells[cells["shard"] == 1]
    assert len(sizes[1]) == -(-2000 // 40) * -(-3000 // 160)
    for _, cell in mine[mine["home"]].groupby("fp"):
        met = set().union(*(set(mine[(mine["part"] == p) & (mine["block"] == b)]["fp"]) for p, b in zip(cell["part"], cell["block"])))
        assert met == set(range(3000))
        break


def test_stage_keeps_unlike_texts_of_one_id(spark):
    one, two = "alpha beta gamma delta epsilon zeta eta theta", "some quite other words stand here today indeed"
    rows = [(1, one), (1, two), (2, one.upper()), (1, one), (None, two + " "), (3, "a third text that nothing else resembles at all")]
    docs = spark.createDataFrame([(*r, "kept") for r in rows], "doc_id long, text string, _row string")
    out = simhash.stage(spark, docs.repartition(3), "")
    assert out.columns == docs.columns
    expected = [(1, one), (1, two), (3, rows[5][1])]
    assert sorted((r.doc_id, r.text) for r in out.collect()) == expected
    again = simhash.stage(spark, docs.orderBy(F.desc("text")).coalesce(1), "").collect()
    assert sorted((r.doc_id, r.text) for r in again) == expected and {r._row for r in again} == {"kept"}
