import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import repeats
from shelfcast.llm.common import sifted


def brute(texts, n):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - n + 1):
            if seen[d[i : i + n]] > 1:
                gone[i : i + n] = True
        runs = int((gone[:-1] & ~np.append(False, gone[:-2] if len(d) else [])[: len(d)]).sum()) if d else 0
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), len(d) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(rng, alphabet, count):
    def words(n):
        return " ".join("".join(rng.choices(alphabet, k=rng.randint(1, 7))) for _ in range(n))

    passages = [words(rng.randint(6, 40)) for _ in range(8)]
    texts = []
    for _ in range(count):
        parts = [words(rng.randint(0, 25)) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, 20)
            parts.insert(rng.randint(0, len(parts)), p[cut:] if rng.random() < 0.5 else p)
        texts.append(" ".join(parts))
    texts += [texts[0], texts[0], texts[1][:-3], "ä" * 300, "ab" * 200, None, "", " ", texts[2] + texts[2]]
    return texts


@pytest.mark.parametrize("alphabet, group", [("abcdefghéü", 1 << 16), ("ab", 1 << 16), ("abcdefghéü", 2)])
def test_against_brute_force(spark, monkeypatch, alphabet, group):
    texts = corpus(random.Random(len(alphabet)), alphabet, 60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.withColumns({"a": F.lit("clash"), "n_bytes": F.lit(0), "extra": F.lit(1)})
    out = repeats.without_repeats(docs, min_bytes=50, anchor_bytes=12, group_pieces=group)
    assert out.columns == ["doc_id", "text", "extra", "n_bytes", "removed", "kept"]
    got = {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in out.collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 50)


def test_long_texts_are_cut_and_pieces_still_meet(spark, monkeypatch):
    rng = random.Random(9)
    long = "".join(rng.choices("abcdefgh ", k=9000))
    texts = [long, "x" + long[3000:6000] + "y", "".join(rng.choices("abcdefgh ", k=3000))]
    data = [t.encode() for t in texts]
    monkeypatch.setattr(repeats, "CUT_BYTES", 700)
    anchors = repeats.Anchors(50, 12)
    starts = [s for start, windows, _, _ in anchors.pieces(data[0]) for s, n in zip(start, windows) for s in range(s, s + n)]
    assert starts == list(range(len(long) - 49))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = repeats.without_repeats(docs, min_bytes=50, anchor_bytes=12)
    got = {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in out.collect()}
    assert [got[i] for i in range(3)] == brute(texts, 50)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.without_repeats(docs).collect() == []


def test_a_column_of_the_temporary_name_passes_through(spark):
    docs = spark.createDataFrame([(1, "abc" * 40, "mine"), (2, "abc" * 40, "mine")], "doc_id long, text string, _cut string")
    out = repeats.without_repeats(docs, min_bytes=50, anchor_bytes=12)
    assert out.columns == ["doc_id", "text", "_cut", "n_bytes", "removed", "kept"]
    assert [(r._cut, r.n_bytes, len(r.kept)) for r in out.collect()] == [("mine", 120, 0)] * 2


@pytest.mark.parametrize("bits", [3, 16, 26])
def test_a_sieve_loses_no_key(spark, bits):
    rows = spark.range(400).select("id", F.xxhash64("id").alias("h"), F.lit("x").alias("_held"), F.lit(1).alias("_bucket"))
    rows = rows.unionByName(spark.createDataFrame([(-1, None, "x", 1)], "id long, h long, _held string, _bucket int"))
    keys = rows.where("id % 5 = 0").select("h").unionByName(rows.select("h").limit(3))
    out = sifted(rows, keys, "h", "may", bits=bits)
    assert out.columns == [*rows.columns, "may"]
    got = {r.id: r.may for r in out.collect()}
    assert len(got) == 401 and not got[-1]
    assert all(got[i] for i in range(0, 400, 5))
    if bits == 26:
        assert sum(got.values()) < 90
    assert not any(r.may for r in sifted(rows, keys.limit(0), "h", "may", bits=bits).collect())


def test_texts_without_spans_keep_their_place_among_the_rows(spark):
    rng = random.Random(5)
    own = ["".join(rng.choices("abcdefgh ", k=200)) for _ in range(30)]
    texts = own + own[:2] + [own[3][:100] + "y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("_likely", F.lit("mine"))
    out = repeats.without_repeats(docs, min_bytes=50, anchor_bytes=12)
    rows = sorted(out.collect(), key=lambda r: r.doc_id)
    assert [r["_likely"] for r in rows] == ["mine"] * len(texts)
    got = [(r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in rows]
    assert got == brute(texts, 50)


@pytest.mark.parametrize("hot", [2, 8, 1 << 12])
def test_hot_contents_are_found_like_others(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_CONTENTS", hot)
    rng = random.Random(hot)
    passage = "".join(rng.choices("abcdefgh ", k=90))
    texts = ["".join(rng.choices("abcdefgh ", k=60)) + passage + "".join(rng.choices("abcdefgh ", k=60)) for _ in range(25)]
    texts += ["xy " * 150, "xy " * 40 + "z", *corpus(rng, "abcdefgh", 20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = repeats.without_repeats(docs, min_bytes=50, anchor_bytes=12)
    rows = sorted(out.collect(), key=lambda r: r.doc_id)
    got = [(r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in rows]
    assert got == brute(texts, 50)


def brute_passages(texts, n):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for w in words:
        covered = sorted({j for i in range(len(w) - n + 1) if seen[tuple(w[i : i + n])] > 1 for j in range(i, i + n)})
        starts = [j for j in covered if j - 1 not in covered]
        ends = [j + 1 for j in covered if j + 1 not in covered]
        out.append(list(zip(starts, ends)))
    return out


@pytest.mark.parametrize("alphabet, group", [("abcdefghéü", 1 << 16), ("ab", 1 << 16), ("ab", 2), ("abcdefghéü", 2)])
def test_passages_against_brute_force(spark, alphabet, group):
    rng = random.Random(7 * len(alphabet))
    texts = [t and t.replace(" ", rng.choice([" ", "\n", " \t ", "\r\n"])) for t in corpus(rng, alphabet, 60)]
    texts += ["ha " * 40, "a b " * 30, " ".join(texts[3].split()[1:]) + " z", "a b " * 5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = repeats.repeated_passages(docs, min_words=9, anchor_words=3, group_pieces=group)
    rows = repeats.identified(docs).join(found, ["a", "b"], "left").collect()
    got = {r.doc_id: [(p.start, p.end) for p in r.passages or []] for r in rows}
    expected = brute_passages(texts, 9)
    assert any(expected) and not all(expected)
    assert [got[i] for i in range(len(texts))] == expected


def test_op10_counts_passages_of_over_50_words_that_have_under_400_bytes(spark, tmp_path):
    rng = random.Random(4)

    def own(n):
        return " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))

    passage = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(52))
    fifty = " ".join(passage.split()[:50])
    assert len(passage) < 400
    texts = [f"{own(60)} {passage} {own(30)}", f"{own(9)}\n{passage}\n{own(80)}", f"{own(70)} {fifty} {own(5)}", own(90), None, ""]
    twice = own(100)
    texts += [twice, twice]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = repeats.op10_repeats(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words", "n_passages"]
    rows = sorted(out.collect())
    assert [tuple(r)[1:5] for r in rows] == brute(texts, 400)
    assert [(r.n_passage_words, r.n_passages) for r in rows] == [(52, 1)] * 2 + [(0, 0)] * 4 + [(100, 1)] * 2
