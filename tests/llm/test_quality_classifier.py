import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from shelfcast.llm import quality


def test_held_out_accuracy(spark, data_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data_dir}/labels.parquet").collect()}
    rows = quality.op9_quality(spark, data_dir).collect()
    assert len(rows) == spark.read.parquet(f"{data_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert len(held) > 40
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) >= 0.95


def test_learns_nothing_from_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"word{i} good text" if i % 2 else f"### word{i} ###") for i in range(200)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = quality.fit(docs, labels), quality.fit(docs, flipped)
    assert (one.weight == two.weight).all() and one.bias == two.bias
    assert one.score("word999 good text") > 0.5 > one.score("### word999 ###")


def test_buckets_are_those_of_the_whole_text(monkeypatch):
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcdéf", k=rng.randint(1, 12))) for _ in range(500))

    def counts():
        total = np.zeros(quality.BUCKETS, int)
        for part in quality.buckets(text):
            total += np.bincount(part, minlength=quality.BUCKETS)
        return total

    whole = counts()
    monkeypatch.setattr(quality, "PART", 200)
    assert (counts() == whole).all()
    words = text.encode().split()
    ngrams = sum(max(0, len(w) + 2 - n + 1) for w in words for n in quality.SIZES)
    assert whole.sum() == ngrams + len(words) + len(words) - 1


def test_words_longer_than_a_part(monkeypatch):
    monkeypatch.setattr(quality, "PART", 40)
    text = "a b " + "xyz" * 50 + " c d " + "q" * 20 + " " + "r" * 21 + " e"

    def total(text):
        return sum(np.bincount(part, minlength=quality.BUCKETS) for part in quality.buckets(text))

    pieces = [w[i : i + 20] for w in text.split() for i in range(0, len(w), 20)]
    got = total(text)
    assert (got == total(" ".join(pieces))).all()
    monkeypatch.setattr(quality, "PART", 1 << 20)
    assert (got == total(" ".join(pieces))).all()


def test_nulls_copies_ties_clashing_names_and_empty_tables(spark):
    texts = [(1, "a fine day"), (1, "a fine day"), (2, None), (None, ""), (3, " "), (4, "x" * 300_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"score": F.lit("old"), "label": F.lit(7)})
    labels = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (None, 1), (4, None), (99, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    out = quality.score(docs, model)
    assert out.columns == ["doc_id", "text", "score", "label"]
    scores = [r.score for r in out.collect()]
    assert scores[0] == scores[1] and scores[2] == scores[3] == scores[4]
    assert quality.score(docs.limit(0), model).collect() == []
    blank = quality.fit(docs, labels.limit(0))
    assert blank.score("anything") == quality.train([], np.zeros(0, int)).score("") == 0.5


def test_long_texts_shut_out_no_others(spark, monkeypatch):
    rows = [(i, "fine words here" if i % 2 else "### !!! ###") for i in range(60)]
    ids = [r.doc_id for r in spark.range(60).withColumnRenamed("id", "doc_id").where(~quality.held_out()).orderBy(F.xxhash64("doc_id")).collect()]
    long = ids[0]
    rows[long] = (long, rows[long][1] * 20_000)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    seen, train = [], quality.train
    monkeypatch.setattr(quality, "train", lambda rows, labels: seen.append(len(rows)) or train(rows, labels))
    quality.fit(docs, labels, size=4000)
    quality.fit(docs, labels, size=quality.BUCKETS + 4000)
    assert seen == [len(ids) - 1, len(ids)]


def test_packed_rows_are_the_shares():
    texts = ["a fine day, a fine day", None, "x " * 1000, "y" * 300]
    for got, text in zip(quality.Rows([quality.packed(t) for t in texts]), texts):
        index, share = quality.shares(text)
        assert (got[0] == index).all() and (got[1] == share).all()


def test_ids_may_be_text(spark):
    docs = spark.createDataFrame([(f"d{i}", f"word{i} good text" if i % 2 else f"### word{i} ###") for i in range(100)], "doc_id string, text string")
    labels = docs.select("doc_id", F.col("text").startswith("word").cast("int").alias("quality"))
    model = quality.fit(docs, labels)
    assert model.score("word7 good text") > 0.5 > model.score("### word7 ###")
