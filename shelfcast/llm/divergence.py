"""Source divergence audit: how far the sources of a language differ in what words they use.

Texts that occur more than once in a language are collapsed before anything is counted: each is tokenised once, and its
counts are added with the number of its copies in every source. The divergence of two sources is then evaluated on the
terms that occur in them; the many terms that one or both lack are accounted for by number, not one by one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import staged, table

MIN_DOCUMENTS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
HELD_TERMS = 200_000  # counters that a task holds before it hands them on
PART_BYTES = 4 << 20  # of a text that are split into words at once
BLOCK_ROWS = 1 << 16  # counts whose pairs of sources are evaluated together
HELD_PAIRS = 1 << 20

#: Bytes of words as they are, A-Z in lower case, every other byte a space. All bytes of characters from 128 on belong to words.
LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size; a word is never cut."""
    data, at = text.translate(LETTERS), 0
    while at < len(data):
        end = data.find(b" ", at + PART_BYTES) if len(data) - at > PART_BYTES else -1
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


_COUNTS = "lang string, source string, term string, n long, d long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term counts ``n`` and document counts ``d`` per language, source and term, of batches (lang, text, copies)."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in groups.items():
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int32))),
                     pa.array([source], pa.string()).take(pa.array(np.zeros(len(n), np.int32))),
                     pa.array(list(n), pa.binary()).cast(pa.string()),
                     pa.array(list(n.values()), pa.int64()),
                     pa.array([d[t] for t in n], pa.int64())],
                    ["lang", "source", "term", "n", "d"],
                )

    for batch in batches:
        lang, text, copies = (batch.column(i) for i in range(3))
        for i in range(batch.num_rows):
            whole: Counter | None = None
            parts = list(_words(data)) if len(data := text[i].as_py()) <= PART_BYTES else None
            for c in copies[i].as_py():
                n, d = groups.setdefault((lang[i].as_py(), c["source"]), (Counter(), Counter()))
                held -= len(n)
                if c["n"] == 1 and parts is not None:
                    for words in parts:
                        n.update(words)
                        d.update(set(words))
                else:
                    if whole is None:
                        whole = Counter()
                        for words in _words(data):
                            whole.update(words)
                    for term, k in whole.items():
                        n[term] += k * c["n"]
                        d[term] += c["n"]
                held += len(n)
            if held > HELD_TERMS:
                yield from rows()
                groups, held = {}, 0
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """Columns of ``_COUNTS``: for each lang, source and term its occurrences ``n`` and the documents with it, ``d``.

    ``docs`` has ``lang, source, text`` without nulls. Texts are grouped by a 128-bit identity per language; the copies
    in each source are counted without moving texts, and one text of a group is tokenised. A task sums the counts of its
    texts before they are shuffled, by language and term: what is partitioned by these stays so for the steps per term.
    """
    named = docs.withColumns({"a": F.xxhash64("text"), "b": F.xxhash64(F.lit(1), "text")})
    copies = (
        named.groupBy("lang", "a", "b", "source")
        .agg(F.count("*").alias("n"))
        .groupBy("lang", "a", "b")
        .agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    )
    texts = named.groupBy("lang", "a", "b").agg(F.first("text").alias("text"))
    collapsed = texts.join(copies, ["lang", "a", "b"]).select("lang", F.col("text").cast("binary"), "copies")
    return (
        collapsed.mapInArrow(_counted, _COUNTS)
        .repartition("lang", "term")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    )


def _share(n: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a term, as a whole number of parts of ``SCALE``; decimal, as counts may pass 2^63 / SCALE."""
    whole = (F.lit(SCALE) * (n + 2).cast("decimal(20,0)")).cast("decimal(38,0)")
    return (F.call_function("div", whole, (total + 2 * terms).cast("decimal(38,0)")) + 1).cast("long")


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


_SHARED = "lang string, source string, other string, excess long"


def _common_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What the terms that two sources share add to the sum of what each has alone, per pair of sources.

    Batches (lang, term, source, p, base) in that order; a term's rows stay together. Pairs are summed as they are
    formed: neighbours at distance 1, 2, ... within a term, for all terms of a block at once.
    """
    keys: list[np.ndarray] = []
    sums: list[np.ndarray] = []

    def total() -> tuple[np.ndarray, np.ndarray]:
        key, place = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_inverse=True)
        out = np.zeros(len(key), np.int64)
        np.add.at(out, place, np.concatenate([np.zeros(0, np.int64), *sums]))
        return key, out

    def work(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        term = rows.groupby(["lang", "term"], sort=False).ngroup().to_numpy()
        group = rows.groupby(["lang", "source"], sort=False)
        code, names = group.ngroup().to_numpy(), group.head(1)[["lang", "source"]].reset_index(drop=True)
        p, base = rows["p"].to_numpy(), rows["base"].to_numpy()
        held = 0

        def out() -> pd.DataFrame:
            key, value = total()
            one, other = names.iloc[key // len(names)], names.iloc[key % len(names)]
            return pd.DataFrame({"lang": one["lang"].to_numpy(), "source": one["source"].to_numpy(),
                                 "other": other["source"].to_numpy(), "excess": value})

        for step in range(1, len(rows)):
            i = np.flatnonzero(term[step:] == term[:-step])
            if not len(i):
                break
            j = i + step
            keys.append(code[i] * len(names) + code[j])
            sums.append(_far(p[i], p[j]) - _far(p[i], base[j]) - _far(base[i], p[j]) + _far(base[i], base[j]))
            held += len(i)
            if held > HELD_PAIRS:
                key, value = total()
                keys[:], sums[:], held = [key], [value], 0
                if len(key) > HELD_PAIRS:
                    yield out()
                    keys[:], sums[:] = [], []
        yield out()
        keys[:], sums[:] = [], []

    waiting: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        waiting.append(batch)
        size += len(batch)
        if size < BLOCK_ROWS:
            continue
        rows = pd.concat(waiting, ignore_index=True)
        last = (rows["lang"] == rows["lang"].iloc[-1]) & (rows["term"] == rows["term"].iloc[-1])
        cut = int(last.to_numpy().argmax())  # the last term may go on
        if cut:
            yield from work(rows.iloc[:cut])
        waiting, size = [rows.iloc[cut:]], len(rows) - cut
    if size:
        yield from work(pd.concat(waiting, ignore_index=True))


def audit(docs: DataFrame, *, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Columns ``lang, source, part, item, value, rank``: for each source of a language, ``pair`` rows with its distance
    to every other source, and ``term`` rows with the ``top_terms`` terms that it uses more than the language does.

    ``docs`` has ``lang, source, text`` (null: empty), other columns are ignored, repeated rows count each; an empty table
    gives no rows, a language without a kept term gives pairs of distance 0. Whole numbers throughout: a term with
    n of N occurrences counted, of V kept terms, has the share ``p = 1 + floor(10^9 (n + 2) / (N + 2V))``, and two shares
    p and q differ by ``floor((p - q)^2 / (p + q))``. Ties are ordered by item.

    The distance of two sources is the sum over all kept terms. With the share of an absent term, the same for all of
    them, it is V times the distance of those two, plus what each source's own terms add to that, which needs only the number of
    terms per share (at most the root of twice the source's words), plus a correction for the terms both have. These are
    the only ones looked at pair by pair; their sums leave a task, the pairs don't. Pairs of sources are as many as the result has rows.
    """
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    term = Window.partitionBy("lang", "term")
    counts = term_counts(docs).withColumns(
        {"total": F.sum("n").over(term), "documents": F.sum("d").over(term), "place": F.row_number().over(term.orderBy("source"))}
    )
    found = staged(counts.where(F.col("documents") >= min_documents).drop("d", "documents"), "kept")
    languages = found.groupBy("lang").agg(F.count_if(F.col("place") == 1).alias("terms"), F.sum("n").alias("words"))
    sizes = found.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(languages, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("size", F.lit(0)).alias("size"), "terms", "words")
    groups = staged(groups.withColumn("base", _share(F.lit(0), F.col("size"), F.col("terms"))), "groups")
    shares = staged(
        found.join(groups, ["lang", "source"]).select(
            "lang", "source", "term", "base", _share(F.col("n"), F.col("size"), F.col("terms")).alias("p"),
            _share(F.col("total"), F.col("words"), F.col("terms")).alias("q"),
        ),
        "shares",
    )

    excess = (
        shares.select("lang", "term", "source", "p", "base")
        .repartition("lang", "term")
        .sortWithinPartitions("lang", "term", "source")
        .mapInPandas(_common_terms, _SHARED)
        .groupBy("lang", "source", "other")
        .agg(F.sum("excess").alias("excess"))
    )
    alone = (
        shares.groupBy("lang", "source", "p")
        .agg(F.count("*").alias("k"))
        .groupBy("lang", "source")
        .agg(F.collect_list(F.struct("p", "k")).alias("own"))
    )
    sides = staged(groups.join(alone, ["lang", "source"], "left").select("lang", "source", "terms", "base", "own"), "sides")
    other = sides.select("lang", F.col("source").alias("other"), F.col("base").alias("other_base"), F.col("own").alias("other_own"))
    neither = _distance(F.col("base"), F.col("other_base"))

    def added(own: str, base: str) -> Column:
        def plus(total: Column, x: Column) -> Column:
            return total + x["k"] * (_distance(x["p"], F.col(base)) - neither)

        return F.coalesce(F.aggregate(own, F.lit(0).cast("long"), plus), F.lit(0))

    pairs = (
        sides.join(other, "lang")
        .where(F.col("source") < F.col("other"))
        .join(excess, ["lang", "source", "other"], "left")
        .select(
            "lang", "source", "other",
            F.coalesce(
                F.col("terms") * neither + added("own", "other_base") + added("other_own", "base") + F.coalesce("excess", F.lit(0)),
                F.lit(0),
            ).alias("value"),
        )
    )
    both_ways = pairs.select("lang", "value", F.explode(F.array(F.struct("source", F.col("other").alias("item")),
                                                                F.struct(F.col("other").alias("source"), F.col("source").alias("item")))).alias("way"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair_rows = both_ways.select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value").withColumn(
        "rank", F.row_number().over(order)
    )
    more = shares.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value")
    )
    term_rows = more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    return pair_rows.unionByName(term_rows)


def op11_divergence(spark: SparkSession, root: str) -> DataFrame:
    return audit(table(spark, root, "documents"))


OP11_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
), words AS (
  SELECT r, lang, source,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), in_document AS (
  SELECT r, lang, source, term, count(*)::HUGEINT AS n FROM words GROUP BY ALL
), counts AS (
  SELECT lang, source, term, sum(n) AS n, count(*) AS d FROM in_document GROUP BY lang, source, term
), kept AS (
  SELECT lang, term, sum(n) AS total FROM counts GROUP BY lang, term HAVING sum(d) >= {MIN_DOCUMENTS}
), languages AS (
  SELECT lang, count(*)::HUGEINT AS terms, sum(total) AS words FROM kept GROUP BY lang
), sources AS (
  SELECT DISTINCT lang, source FROM docs
), cells AS (
  SELECT s.lang, s.source, k.term, k.total, coalesce(c.n, 0) AS n
  FROM sources s JOIN kept k ON k.lang = s.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), sized AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source) AS size FROM cells
), shares AS (
  SELECT z.lang, z.source, z.term, z.n,
         1 + ({SCALE}::HUGEINT * (z.n + 2)) // (z.size + 2 * l.terms) AS p,
         1 + ({SCALE}::HUGEINT * (z.total + 2)) // (l.words + 2 * l.terms) AS q
  FROM sized z JOIN languages l ON l.lang = z.lang
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM listed
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
