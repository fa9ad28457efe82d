import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, lang string, source string, text string"


def plain(rows, min_documents, top):
    docs = [tuple(x or "" for x in r[1:4]) for r in rows]
    counts, documents = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        words = TERM.findall(text)
        counts[lang, source].update(words)
        documents[lang].update(set(words))
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for t, d in documents[lang].items() if d >= min_documents]
        sources = sorted({d[1] for d in docs if d[0] == lang}, key=str.encode)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [(x, sum(f(p[s][t], p[x][t]) for t in kept)) for x in sources if x != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


def result(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS term", "'x' AS copies", "2 AS a", "3 AS p", "'o' AS item")
    return sorted(map(tuple, divergence.audit(docs.repartition(5), **options).collect()))


def corpus(seed):
    rng = random.Random(seed)
    words = ["River", "STONE", "ärger", "été", "日本", "a", "İx", "x_y", "n0w", "b c", "ﬀ"] + ["w" + c for c in "abcdefghijk"]
    rows = []
    for i in range(160):
        lang = rng.choice(["en", "de", None, ""])
        text = " ".join(rng.choices(words, weights=range(1, len(words) + 1), k=rng.randint(0, 12)))
        rows.append((i, lang, rng.choice(["s1", "s2", "ö", "S1", None]), rng.choice([text, text, text, None, "same words here"])))
    rows += [(900 + i, "en", "s1" if i % 3 else "s2", "the same long text " * 3) for i in range(60)]  # one group of copies
    rows += [(1000, "en", "empty", ""), (1001, "fr", "alone", "one two"), (1002, "it", "p", "uno"), (1003, "it", "q", None)]
    return rows + [rows[0], rows[0], (None, "en", "s1", "river " * 5000)]


@pytest.mark.parametrize("seed, least", [(1, 3), (2, 10)])
def test_against_brute_force(spark, seed, least):
    rows = corpus(seed)
    expected = plain(rows, least, 4)
    assert {r[2] for r in expected} == {"pair", "term"} and any(r[4] == 0 for r in expected if r[0] == "it")
    assert result(spark, rows, min_documents=least, top_terms=4) == expected


def test_small_blocks_give_the_same(spark, monkeypatch):
    # functions travel by value, so the workers see these limits
    rows = corpus(3)
    expected = plain(rows, 2, 10)
    for name, value in (("HELD_TERMS", 5), ("PART_BYTES", 16), ("BLOCK_ROWS", 7), ("HELD_PAIRS", 3)):
        monkeypatch.setattr(divergence, name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        assert result(spark, rows, min_documents=2) == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_words_are_whole_in_every_part(monkeypatch):
    monkeypatch.setattr(divergence, "PART_BYTES", 3)
    text = "One two,THREE  é" + "x" * 50 + " 7end"
    assert [w for part in divergence._words(text.encode()) for w in part] == [
        w.encode() for w in TERM.findall(text.lower())
    ]
    assert list(divergence._words(b"")) == []


def test_shares_beyond_long_products(spark):
    n = 9 * 10**15
    row = spark.range(1).select(divergence._share(F.lit(n), F.lit(2 * n), F.lit(7)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 2) // (2 * n + 14)


def test_empty_table(spark):
    assert result(spark, []) == []
