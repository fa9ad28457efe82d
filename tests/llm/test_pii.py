import hashlib
import re

from pyspark.sql import functions as F

from shelfcast.llm import pii

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(v - 9 * (v > 9) for v in doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def plain(text):
    found = [
        (m.start(), place, m.end(), kind)
        for place, kind in enumerate(pii.KINDS)
        for m in re.finditer(RULES[kind], text or "")
        if holds(kind, m[0])
    ]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


TEXTS = [
    "Write to ann.lee@mail.example.org, call +49 (30) 555-0199 or pay with 4111 1111 1111 1111.",
    "été 10.0.0.255 und 10.0.0.256; 1.2.3.4.5.6.7.8 12345678901234567890 +1 +12 +123456789 4111-1111-1111-1112",
    "a@b.c_d@e.f x@y@z.com .@-.- @a.b a@b 00.00.00.000 0004.3.2.1 +1(234)567.8901) 4111 1111  1111 1111",
    "\U0001f600 p@q.rs\n\U0001f600 +1 222 333 4444\n5555555555554444\r\n" * 3,
    "1" * 3000 + " " + "a" * 3000 + "@ " + "+1" + "2" * 3000,
    "12 34 " * 2000,
    "1.2.3.4 " * 1500,
    "",
    None,
    "nothing here",
]


def test_rules_equal_plain_matching(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (None, TEXTS[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("clash")).withColumn("row", F.lit(1))
    spark.createDataFrame(rows, "doc_id long, text string").createOrReplaceTempView("unused")
    out = pii.find_personal_data(docs)
    digest = out.select("doc_id", pii._joined(F.col("base")).alias("base"), pii._joined(F.col("spans")).alias("spans")).collect()
    assert len(digest) == len(rows)
    for row in digest:
        want = plain(TEXTS[row.doc_id or 0])
        assert list(filter(None, row.base.split(","))) == want
        assert set(want) <= set(filter(None, row.spans.split(",")))


def test_query_columns_on_whole_table(spark, data_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = pii.op7_pii(spark, data_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain(docs[r.doc_id])
        kinds = [w.split(":")[0] for w in want]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()


def test_trees_add_what_looks_like_the_confirmed(spark):
    lines = [f"Please call our office at +1 ({200 + i % 700}) 555-{1000 + i} today." for i in range(300)]
    lines += [f"Order no. {1000 + i} {2000 + i} {3000 + i} was shipped." for i in range(300)]
    lines += ["Please call our office at 00 1 (415) 555-2671 today."]
    out = pii.find_personal_data(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    added = {r.doc_id: r.spans for r in out.where("size(spans) > size(base)").collect()}
    assert not any(300 <= d < 600 for d in added)


def test_trees_add_other_spellings(spark):
    lines = [f"Please call our office at +{1 + i % 60} ({200 + i % 700}) 555-{1000 + i} today." for i in range(300)]
    lines += [f"Please write to {'annabella'[: 3 + i % 7]}{'._'[i % 2]}{i}@{'mailhost'[: 2 + i % 6]}.{['com', 'example.org'][i % 2]} for help." for i in range(300)]
    lines += [f"Please pay with card {4000 + i} {1000 + i} 2222 {3000 + i} now." for i in range(900)]
    lines += [f"Order no. {1000 + i} {2000 + i} {3000 + i} was shipped." for i in range(300)]
    lines += [f"We look [at] it{i} again, as x{i}@y said." for i in range(100)]
    n = len(lines)
    lines += [
        "Please write to ann [at] host [dot] com for help.",
        "Please call our office at 0049 (30) 555-0199 today.",
        "Please call our office at 00 1 (415) 555-2671 today.",
        "Please pay with card 4111.1111.1111.1111 now.",
        "Please pay with card 4111/1111/1111/1111 now.",
    ]
    out = pii.find_personal_data(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    added = {r.doc_id: [(s.kind, lines[r.doc_id][s.start : s.end]) for s in r.spans] for r in out.where("size(spans) > size(base)").collect()}
    assert ("email", "ann [at] host [dot] com") in added[n]
    assert ("phone", "0049 (30) 555-0199") in added[n + 1]
    assert ("phone", "00 1 (415) 555-2671") in added[n + 2]
    assert ("card", "4111.1111.1111.1111") in added[n + 3] and ("card", "4111/1111/1111/1111") in added[n + 4]
    assert not any(1500 <= d < n for d in added)


def test_sample_is_filtered_in_parallel(spark, monkeypatch):
    plans, staged = {}, pii.staged

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, name)

    monkeypatch.setattr(pii, "staged", seen)
    lines = [f"call +1 ({200 + i}) 555-{1000 + i}, order {1000 + i} {2000 + i} {3000 + i}" for i in range(50)]
    pii.find_personal_data(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    assert "Coalesce " not in plans["candidates"] and "Exchange SinglePartition" in plans["candidates"]


def test_trees_learn_from_all_candidates(spark, monkeypatch):
    stored, plans, staged = {}, {}, pii.staged

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        stored[name] = staged(df, name)
        return stored[name]

    monkeypatch.setattr(pii, "staged", seen)
    lines = [f"call +1 ({200 + i}) 555-{1000 + i}, order {1000 + i} {2000 + i} {3000 + i}" for i in range(100)]
    pii.find_personal_data(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), per_task=30)
    wide = stored["spans"].select("row", "base", F.explode("wide").alias("c")).select("row", "base", "c.*")
    assert stored["candidates"].count() == pii.examples(wide).count() >= 100
    assert "SinglePartition" not in plans["candidates"]


def test_empty_table_and_texts_without_candidates(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_personal_data(empty).collect() == []
    clean = spark.createDataFrame([(1, "no data at all"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.base, r.spans) for r in pii.find_personal_data(clean).collect()) == [(1, [], []), (2, [], [])]
