import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import packing

TEXTS = [
    "a  b", "a   b\n  c \n d", " lead", "trail ", "it's 'so' we'll 12 3456 ...", "tab\t x  y z  ", "", " ", "\n", "é 日本 語  \U0001f600",
    "one two three\nfour five", "x" * 5000, "   ",
]


@pytest.fixture(scope="module")
def tokens():
    with open(packing.RANKS, "rb") as file:
        return packing.Tokens(file.read())


def test_ids_equal_the_tokenizer(tokens, spark, data_dir, monkeypatch):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{data_dir}/documents.parquet").select("text").collect()]
    want = [tokens.encoding.encode_ordinary(t) for t in texts]
    assert [tokens.of(t).tolist() for t in texts] == want
    monkeypatch.setattr(packing, "PART_CHARS", 97)
    assert [tokens.of(t).tolist() for t in texts[:100]] == want[:100]


def test_best_fit_against_a_plain_search():
    rng = random.Random(4)
    for _ in range(30):
        lengths = [rng.randint(0, 40) for _ in range(rng.randint(0, 60))]
        got = packing.pack(np.array(lengths, np.int64), 16)
        rests = sorted(((i, n // 16 * 16, n) for i, n in enumerate(lengths) if n % 16), key=lambda s: s[1] - s[2])
        bins = []
        for i, start, end in rests:
            fitting = [b for b in bins if b[0] >= end - start]
            if fitting:
                least = min(b[0] for b in fitting)
                b = next(b for b in bins if b[0] == least)
            else:
                b = [16, []]
                bins.append(b)
            b[0] -= end - start
            b[1].append((i, start, end))
        full = sum(n // 16 for n in lengths)
        assert len(got) == full + len(bins)
        assert sorted(sum(e - s for _, s, e in r) for r in got) == sorted([16] * full + [16 - b[0] for b in bins])
        seen = sorted(s for r in got for s in r)
        assert [(d, e - s) for d, s, e in seen if e - s] and sum(e - s for _, s, e in seen) == sum(lengths) or not sum(lengths)


def restored(rows, length, end_id):
    documents = {}
    for r in rows:
        ids, positions = np.frombuffer(r.ids, "<i4"), np.frombuffer(r.positions, "<i4")
        assert len(ids) == len(positions) == length
        bounds = r.cu_seqlens
        assert bounds[0] == 0 and bounds[-1] == r.n_tokens <= length and (ids[r.n_tokens :] == end_id).all()
        for a, b in zip(bounds, [*bounds[1:], length]):
            assert (positions[a:b] == np.arange(b - a)).all()
        for a, b, doc, start in zip(bounds, bounds[1:], r.doc_ids, r.starts):
            documents.setdefault(doc, {})[start] = ids[a:b].tolist()
    return {d: [x for s in sorted(parts) for x in parts[s]] for d, parts in documents.items()}


def test_round_trip_of_nulls_copies_long_texts_and_clashing_names(spark, tokens):
    texts = [*TEXTS, None, "word " * 9000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"ids": F.lit(1), "pack": F.lit("x")})
    rows = packing.packed(docs.repartition(3), length=64, block_tokens=500).collect()
    assert len({r.pack for r in rows}) == len(rows)
    got = restored(rows, 64, packing.END_ID)
    assert got == {i: [*tokens.encoding.encode_ordinary(t or ""), packing.END_ID] for i, t in enumerate(texts)}
    copies = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert sum(r.n_tokens for r in packing.packed(copies).collect()) == 12
    assert packing.packed(docs.limit(0)).collect() == []


def test_whole_table(spark, data_dir, tokens):
    rows = packing.op3_packing(spark, data_dir).collect()
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()
    got = restored(rows, packing.LENGTH, packing.END_ID)
    assert got == {d.doc_id: [*tokens.encoding.encode_ordinary(d.text), packing.END_ID] for d in docs}
    assert sum(r.n_tokens for r in rows) > 0.98 * packing.LENGTH * len(rows)


def test_ids_keep_their_type(spark):
    docs = spark.createDataFrame([("a-1", "one two"), (None, "three"), ("b", None)], "doc_id string, text string")
    out = packing.packed(docs)
    assert dict(out.dtypes)["doc_ids"] == "array<string>"
    assert sorted((d for r in out.collect() for d in r.doc_ids), key=str) == [None, "a-1", "b"]
