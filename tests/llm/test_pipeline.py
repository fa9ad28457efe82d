"""The pipeline's stages against plain versions, on a small corpus with planted cases."""

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from shelfcast.llm import decontamination, mixing, packing, repeats, repetition, simhash
from shelfcast.llm.common import connected_components
from shelfcast.sources.tables import release, stage_root, stored_so_far

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SYLLABLES = [a + b for a in "bcdfglmnprst" for b in "aeiou"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=rng.randint(30, 300))) for _ in range(150)]
    items = [" ".join(rng.choices(words, k=30)) + "." for _ in range(5)]
    texts[3] = "again and again " * 60  # fails the quality rules
    texts[4] = "short"
    texts[5] = None
    texts[11] = texts[10]  # copies; 12 differs in letter case and spaces only
    texts[12] = texts[10].upper().replace(" ", "  ")
    texts[20] = texts[20] + " " + items[0]
    texts[21] = texts[21] + " " + items[1]
    rows = [(i, t, "en", f"s{min(i % 7, 3)}", len(t or "")) for i, t in enumerate(texts)]
    path = tmp_path_factory.mktemp("corpus")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, folder), name)
        assert docs.columns == COLUMNS
        kept[name] = [r.doc_id for r in docs.collect()]
    everything = set(range(150))
    assert everything - set(kept["quality_rules"]) == {3, 4, 5}
    assert set(kept["quality_rules"]) - set(kept["near_duplicates"]) == {11, 12}
    assert len(kept["near_duplicates"]) == len(set(kept["near_duplicates"]))
    assert set(kept["near_duplicates"]) - set(kept["decontamination"]) == {20, 21}
    assert set(kept["mixing"]) <= set(kept["decontamination"])

    with open(packing.RANKS, "rb") as file:
        encoding = packing.Tokens(file.read()).encoding
    mixed = docs.collect()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    tokens = Counter()
    for r in packed:
        ids = np.frombuffer(r.ids, "<i4")
        for a, b, doc in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids):
            tokens[doc] += b - a
    assert tokens == Counter({d: sum(len(encoding.encode_ordinary(r.text)) + 1 for r in mixed if r.doc_id == d) for d in kept["mixing"]})
    assert sum(r.n_tokens for r in corpus_pipeline.run(spark, folder).collect()) == sum(tokens.values())


def test_empty_corpus(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_mixing_reaches_the_target_shares(spark):
    rows = [(i, "x" * 9, "s0" if i % 3 else "s1") for i in range(30_000)] + [(-1, None, None), (-1, None, None), (-2, "", "s9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, {"s0": 1.0, "s1": 3.0}, volume=2.0)
    assert out.columns == ["doc_id", "text", "source", "copy", "mix_key"]
    counts = Counter(r.source for r in out.collect())
    assert counts["s0"] == pytest.approx(15_000, rel=0.05) and counts["s1"] == pytest.approx(45_000, rel=0.05)
    assert set(counts) == {"s0", "s1"}  # no weight, no copies
    again = mixing.mix(docs.repartition(7), {"s0": 1.0, "s1": 3.0}, volume=2.0)
    assert sorted(r.mix_key for r in again.collect()) == sorted(r.mix_key for r in out.collect())
    assert mixing.mix(docs.limit(0)).collect() == []


def test_copies_follow_the_poisson_distribution(spark):
    docs = spark.createDataFrame([(i, "x", "s") for i in range(40_000)], "doc_id long, text string, source string")
    counts = Counter(r.doc_id for r in mixing.mix(docs, {"s": 1.0}, volume=1.5).select("doc_id").collect())
    share = Counter(counts.get(i, 0) for i in range(40_000))
    for k, p in enumerate([0.2231, 0.3347, 0.2510, 0.1255, 0.0471]):
        assert share[k] / 40_000 == pytest.approx(p, abs=0.01)


def brute_repetition(text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    n, longest = len(words), [0] * len(words)
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            longest[i] = max(longest[i], k)

    def covered(least, exact):
        inside = set()
        for i, k in enumerate(longest):
            if k >= least:
                inside.update(range(i, i + (least if exact else k)))
        return len(inside)

    repeat, cover = covered(repetition.WINDOW, True), covered(repetition.MIN_REPEAT, False)
    failed = n < 20 or 100 * repeat > 30 * n
    kept = not failed and cover <= repetition.MAX_COVERED * n and max(longest, default=0) <= repetition.MAX_REPEAT
    return n, repeat, failed, cover, max(longest, default=0), kept


def test_repetition_against_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    texts = [None, "", " \n\t", "a", "a a", "b " * 70, "one two three four five six seven eight nine ten " * 3]
    for _ in range(60):
        base = rng.choices("abcdef", k=rng.randint(0, 60))
        if base and rng.random() < 0.7:
            base += rng.choices("uvwxyz", k=rng.randint(0, 60)) + base[rng.randint(0, len(base)) :]
        texts.append(rng.choice([" ", "\n", "  "]).join(base))
    rows = list(enumerate(texts)) + [(None, texts[8])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS repetition", "2 AS n_words")
    out = repetition.with_repetition(docs)
    assert out.columns == ["doc_id", "text", "repetition", "n_words"]
    for row in out.collect():
        m = row.repetition
        assert (m.n_words, m.n_repeat_words, m.base_failed, m.n_covered_words, m.longest_repeat, m.kept) == brute_repetition(row.text)
    monkeypatch.setattr(repetition, "BLOCK_WORDS", 30)
    import pyarrow as pa

    small = repetition.measure(pa.array(texts, pa.string()))
    assert [tuple(r) for r in small[["n_repeat_words", "longest_repeat"]].to_numpy().tolist()] == [
        (b[1], b[4]) for b in map(brute_repetition, texts)
    ]
    assert repetition.with_repetition(docs.limit(0)).collect() == []


def test_fingerprints_of_long_texts_are_cut_in_blocks(monkeypatch):
    text = " ".join(random.Random(1).choices(SYLLABLES, k=500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "HASH_BLOCK", 7)
    assert simhash.fingerprint(text) == whole


def test_rows_without_id_are_dealt_out(spark):
    docs = spark.createDataFrame([(None, f"text {i} " * 3, "s") for i in range(400)], "doc_id long, text string, source string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = mixing.mix(docs)
        parts = out.where("copy = 0").selectExpr("spark_partition_id() AS part").distinct().count()
        assert parts > 1 and "_place" not in out.columns
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_intermediate_tables_go_when_their_reader_is_stored(spark, folder):
    root, mark = Path(stage_root(spark)), stored_so_far()
    before = set(root.iterdir()) if root.exists() else set()

    def left():
        names = sorted(p.name.rsplit("-", 1)[0] for p in set(root.iterdir()) - before)
        assert len(names) == stored_so_far() - mark
        return names

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {r.root for r in connected_components(path).collect()} == {0} and left() == ["llm-links"]
    release(spark, mark)
    simhash.near_duplicates(docs).count()
    assert left() == ["llm-fingerprints", "llm-labels", "llm-points"]
    release(spark, mark)
    repeats.without_repeats(docs).count()
    assert left() == ["llm-spans"]
    release(spark, mark)
    decontamination.with_leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).count()
    assert left() == []
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and left() == ["llm-mixing"]  # the last stage reads it
    release(spark, mark)
    assert set(root.iterdir()) == before
