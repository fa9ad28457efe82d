"""Quality rules: repeated substrings inside a document, found with suffix arrays over its words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shelfcast.llm.common import ascii_words, parts, table, unused

MIN_REPEAT = 12  # words: a shorter repeat is no repeat for the method
MAX_COVERED = 0.25  # fraction of words inside repeats
MAX_REPEAT = 80  # words: the longest repeat a kept document may have
WINDOW = 8  # words, of the base rule
BLOCK_WORDS = 1 << 20  # documents are indexed together up to about this many words

METRICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_covered_words long, longest_repeat long, kept boolean"
)


def suffix_order(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of several documents at once, and the longest common prefix of each suffix with the one before.

    A suffix ends with its document and is compared with suffixes of the same document only: the first sort key holds
    the document. Prefix doubling sorts in each round only the suffixes that still have an equal; the ranks of all
    rounds give the common prefixes without reading the symbols again.
    """
    n = len(symbols)
    ends = np.append(np.flatnonzero(np.diff(owner)) + 1, n)
    end_of = np.repeat(ends, np.diff(np.append(0, ends)))
    _, rank = np.unique(owner.astype(np.int64) * (int(symbols.max()) + 1) + symbols, return_inverse=True)
    order = np.argsort(rank, kind="stable")
    # a rank is the place in the order where its equals begin
    starts = np.flatnonzero(np.append(True, np.diff(rank[order]) != 0))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    levels, width = [rank], 1
    while True:
        sorted_rank = rank[order]
        same = np.append(False, np.diff(sorted_rank) == 0)
        tied = same | np.append(same[1:], False)
        if not tied.any():
            break
        places = np.flatnonzero(tied)
        here = order[places]
        after = here + width
        inside = after < end_of[here]
        second = np.where(inside, rank[np.minimum(after, n - 1)], -1)
        first = rank[here]
        by = np.lexsort((second, first))
        here, first, second = here[by], first[by], second[by]
        order[places] = here
        new = np.append(True, (np.diff(first) != 0) | (np.diff(second) != 0))
        rank = rank.copy()
        group = np.flatnonzero(new)
        rank[here] = np.repeat(places[group], np.diff(np.append(group, len(here))))
        levels.append(rank)
        width *= 2
    shared = np.zeros(n, np.int64)
    left, right = order[:-1].copy(), order[1:].copy()
    for level in range(len(levels) - 1, -1, -1):
        ok = (left < end_of[order[:-1]]) & (right < end_of[order[1:]])
        equal = np.zeros(n - 1, bool)
        equal[ok] = levels[level][left[ok]] == levels[level][right[ok]]
        # equal ranks mean equal prefixes of this width only if both suffixes are that long
        equal &= (left + (1 << level) <= end_of[order[:-1]]) & (right + (1 << level) <= end_of[order[1:]])
        shared[1:][equal] += 1 << level
        left[equal] += 1 << level
        right[equal] += 1 << level
    return order, shared


def repeated_spans(symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each position the length of the longest string from there that occurs elsewhere in its document."""
    if len(symbols) < 2:
        return np.zeros(len(symbols), np.int64)
    order, shared = suffix_order(symbols, owner)
    longest = np.empty(len(symbols), np.int64)
    # the longest interval that a suffix belongs to: its larger common prefix with a neighbour in the order
    longest[order] = np.maximum(shared, np.append(shared[1:], 0))
    return longest


def covered(lengths: np.ndarray) -> np.ndarray:
    """Positions inside the union of the spans [p, p + lengths[p])."""
    n = len(lengths)
    starts = np.flatnonzero(lengths)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths[starts], -1)
    return np.cumsum(change[:-1]) > 0


def _sum(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flags))
    return total[offsets[1:]] - total[offsets[:-1]]


def _dup_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line and not line.isspace() or line.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def measure(
    texts: pa.Array, *, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_repeat: int = MAX_REPEAT
) -> pd.DataFrame:
    """The metrics of each text; documents are indexed together in blocks of ``BLOCK_WORDS`` words."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    words, offsets = ascii_words(texts)
    symbols = words.dictionary_encode().indices.to_numpy().astype(np.int64) if len(words) else np.zeros(0, np.int64)
    counts = np.diff(offsets)
    owner = np.repeat(np.arange(len(counts)), counts)
    longest = np.zeros(len(symbols), np.int64)
    begin = 0
    while begin < len(counts):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + BLOCK_WORDS, "right")) - 1)
        part = slice(offsets[begin], offsets[end])
        longest[part] = repeated_spans(symbols[part], owner[part])
        begin = end
    window = np.where(longest >= WINDOW, WINDOW, 0)
    repeat_words = _sum(covered(window), offsets)
    covered_words = _sum(covered(np.where(longest >= min_repeat, longest, 0)), offsets)
    top = np.zeros(len(counts), np.int64)
    np.maximum.at(top, owner, longest)
    length = pc.utf8_length(texts).to_numpy()
    spaces = pc.count_substring_regex(texts, "[ \\t\\n\\v\\f\\r]").to_numpy()
    out = pd.DataFrame({"n_words": counts, "word_chars": length - spaces})
    out["n_symbols"] = pc.count_substring_regex(texts, r"[#*$%&|<>]").to_numpy()
    out["n_dup_lines"] = [_dup_lines(t) for t in texts.to_pylist()]
    out["n_repeat_words"] = repeat_words
    out["base_failed"] = (counts < 20) | (100 * repeat_words > 30 * counts)
    out["n_covered_words"] = covered_words
    out["longest_repeat"] = top
    out["kept"] = ~out["base_failed"] & (covered_words <= max_covered * counts) & (top <= max_repeat)
    return out


def with_repetition(
    docs: DataFrame,
    column: str = "text",
    *,
    name: str = "repetition",
    min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """``docs`` with a struct column ``name`` of repetition metrics; a column of that name is replaced.

    The maximal repeated substrings of a document (in words) are the longest-common-prefix intervals of its suffix
    array; a document is kept if the base rule holds, the union of the occurrences of repeats of at least
    ``min_repeat`` words covers at most ``max_covered`` of its words, and no repeat is longer than ``max_repeat``.
    Overlapping occurrences count ("a a a" repeats "a a"). Null and empty texts have no words and fail the base rule.
    Rows are judged one by one: no shuffle; repeated rows get equal results, an empty table gives no rows, other
    columns pass through.
    """

    @arrow_udf(METRICS)
    def metrics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            limits = {"min_repeat": min_repeat, "max_covered": max_covered, "max_repeat": max_repeat}
            found = pd.concat([measure(part, **limits) for part in parts(texts)] or [measure(texts, **limits)])
            yield pa.RecordBatch.from_pandas(found, preserve_index=False).to_struct_array()

    return docs.withColumn(name, metrics(F.col(column).cast("string")))


def op2_repetition(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    return with_repetition(docs).select("doc_id", "repetition.*")


def stage(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    """Pipeline stage: the documents that the rules keep."""
    name = unused(docs, "_repetition")
    return with_repetition(docs, name=name).where(f"{name}.kept").select(*docs.columns)


_SPLIT = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def _covered(length: int, windows: str) -> str:
    """Words inside windows of ``length`` words (rows r, p, h) that occur twice or more in their document."""
    return f"""
  SELECT r, count(*) AS n FROM (
    SELECT DISTINCT r, p + unnest(range({length})) AS p FROM (
      SELECT r, p, count(*) OVER (PARTITION BY r, h) AS k FROM {windows}
    ) WHERE k > 1
  ) GROUP BY r"""


def _longest(levels: int = 16) -> str:
    """The longest repeat of each document: hashes of all strings of 1, 2, 4, ... words by doubling, then the length bit by bit
    from the largest, keeping the places whose string is still repeated."""
    steps = ["level0 AS (SELECT r, unnest(range(1, len(words) + 1)) AS p, hash(unnest(words)) AS h FROM split)"]
    for i in range(1, levels):
        steps.append(
            f"level{i} AS MATERIALIZED (SELECT a.r, a.p, hash(a.h, b.h) AS h FROM level{i - 1} a"
            f" JOIN level{i - 1} b ON b.r = a.r AND b.p = a.p + {1 << (i - 1)})"
        )
    steps.append(f"place{levels} AS (SELECT r, p, 0 AS n, 0::UBIGINT AS h FROM level0)")
    for i in reversed(range(levels)):
        steps.append(
            f"longer{i} AS MATERIALIZED (SELECT r, p, n, h FROM (SELECT w.r, w.p, w.n + {1 << i} AS n, hash(w.h, v.h) AS h,"
            f" count(*) OVER (PARTITION BY w.r, hash(w.h, v.h)) AS k FROM place{i + 1} w"
            f" JOIN level{i} v ON v.r = w.r AND v.p = w.p + w.n) WHERE k > 1)"
        )
        steps.append(
            f"place{i} AS MATERIALIZED (SELECT * FROM longer{i} UNION ALL"
            f" SELECT * FROM place{i + 1} WHERE r NOT IN (SELECT r FROM longer{i}))"
        )
    steps.append("longest AS (SELECT r, max(n) AS n FROM place0 GROUP BY r)")
    return ", ".join(steps)


OP2_SQL = f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_SPLIT} AS words FROM documents
), {_longest()}, windows12 AS (
  SELECT a.r, a.p, hash(a.h, b.h) AS h FROM level3 a JOIN level2 b ON b.r = a.r AND b.p = a.p + 8
), repeats8 AS ({_covered(WINDOW, "level3")}
), repeats AS ({_covered(MIN_REPEAT, "windows12")}
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM split)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(repeats8.n, 0)::BIGINT AS n_repeat_words,
         coalesce(repeats.n, 0)::BIGINT AS n_covered_words, coalesce(longest.n, 0)::BIGINT AS longest_repeat
  FROM split LEFT JOIN lines USING (r) LEFT JOIN repeats8 USING (r) LEFT JOIN repeats USING (r)
       LEFT JOIN longest USING (r)
), judged AS (
  SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM measured
)
SELECT *, (NOT base_failed AND n_covered_words <= {MAX_COVERED} * n_words AND longest_repeat <= {MAX_REPEAT}) AS kept
FROM judged
"""
