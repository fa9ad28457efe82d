"""Removing long strings that occur more than once in the corpus, by column-wise construction over aligned pieces.

The method inserts one symbol of every string per round, from the right end to the left, and keeps the strings in the
order of what was inserted so far, with the common prefix of neighbours. Whole documents would need as many rounds as
the longest one has bytes, each over the whole collection. So the collection is first cut into short pieces that can be
compared on their own: every window of ``min_bytes`` bytes belongs to the piece of its smallest hashed byte string (its
anchor), equal windows have equal anchors at equal distances, and only pieces with the same anchor can share windows.
Aligned at the anchor, all pieces of a group take part in the same rounds, and the order of the current column is all
that a round needs.

The strings are the bytes of the texts (``without_repeats``) or the hashes of their words (``repeated_passages``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shelfcast.llm.common import powers, sifted, staged, table, unused
from shelfcast.sources.tables import stored_so_far

MIN_BYTES = 400
ANCHOR_BYTES = 64
MIN_WORDS = 51
ANCHOR_WORDS = 8
WORD_BYTES = 8
CUT_BYTES = 1 << 20  # longer texts are indexed in overlapping cuts (of as many words, where words are compared)
BLOCK_BYTES = 8 << 20  # pieces that go through the rounds together
HOT_CONTENTS = 1 << 12  # a content with more than this part of all pieces is hot: there are fewer than this many
GROUP_PIECES = 1 << 16  # larger groups are compared window by window, see ``_crowded``
MIX = np.uint64(0x9E3779B97F4A7C15)


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def word_hashes(text: str) -> bytes:
    """``WORD_BYTES`` bytes for each word ``[^\\x20\\x09-\\x0D]+``, a 64-bit hash of it."""
    return b"".join(map(xxhash.xxh3_64_digest, utf8(text).split()))


class Anchors:
    """Cuts texts into pieces of consecutive windows with the same anchor. All lengths and positions are in symbols of
    ``width`` bytes, 1 or 8."""

    def __init__(self, min_bytes: int, anchor_bytes: int, width: int = 1) -> None:
        self.min_bytes, self.anchor_bytes, self.width = min_bytes, anchor_bytes, width
        size = CUT_BYTES + min_bytes
        self.up, self.down = powers(size + 1)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """A hash of the ``anchor_bytes`` symbols at each position, from prefix sums."""
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=prefix[1:])
        n = len(data) - self.anchor_bytes + 1
        mixed = (prefix[self.anchor_bytes :] - prefix[:n]) * self.down[:n]
        mixed ^= mixed >> np.uint64(29)
        mixed *= MIX
        return mixed ^ (mixed >> np.uint64(32))

    def pieces(self, text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        """Arrays (start, windows, anchor's distance from the start, anchor hash) for each cut of a text."""
        symbols = np.frombuffer(text, f"u{self.width}")
        for cut in range(0, len(symbols) - self.min_bytes + 1, CUT_BYTES):
            data = symbols[cut : cut + CUT_BYTES + self.min_bytes - 1]
            hashed = self.hashes(data)
            reach = self.min_bytes - self.anchor_bytes + 1
            windows = len(data) - self.min_bytes + 1
            low = np.uint64((1 << 24) - 1)
            ranked = (hashed & ~low) | np.arange(len(hashed), dtype=np.uint64)  # ties: leftmost
            padded = np.full(-(-len(ranked) // reach) * reach, np.iinfo(np.uint64).max)
            padded[: len(ranked)] = ranked
            blocks = padded.reshape(-1, reach)
            ahead = np.minimum.accumulate(blocks, axis=1).ravel()
            behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
            least = np.minimum(behind[:windows], ahead[reach - 1 : reach - 1 + windows])
            anchor = (least & low).astype(np.int64)
            start = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
            yield cut + start, np.diff(np.append(start, windows)), anchor[start] - start, hashed[anchor[start]]


def _index(anchors: Anchors, encode: Callable[[str], bytes]):
    """Rows of ``_PIECES`` for batches of (a, b, text)."""
    width = anchors.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list[np.ndarray]] = []
            size = 0
            for a, b, text in zip(*(batch.column(i) for i in range(3))):
                data = encode(text.as_py())
                for start, windows, at, key in anchors.pieces(data):
                    ends = width * (start + windows + anchors.min_bytes - 1)
                    content = np.fromiter(
                        (xxhash.xxh3_64_intdigest(data[i:j]) for i, j in zip((width * start).tolist(), ends.tolist())), np.uint64
                    )
                    rows.append([np.full(len(start), a.as_py()), np.full(len(start), b.as_py()), start, windows, at,
                                 key.view(np.int64), content.view(np.int64)])
                    size += len(start)
                    if size > 1 << 18:
                        yield _rows(rows)
                        rows, size = [], 0
            if rows:
                yield _rows(rows)

    return run


_PIECES = "a long, b long, start long, windows int, at int, key long, content long"


def _rows(rows: list[list[np.ndarray]]) -> pa.RecordBatch:
    types = [np.int64, np.int64, np.int64, np.int32, np.int32, np.int64, np.int64]
    columns = [np.concatenate(c).astype(t) for c, t in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [p.split()[0] for p in _PIECES.split(", ")])


def column_rounds(strings: list[bytes], at: np.ndarray, group: np.ndarray, min_bytes: int) -> np.ndarray:
    """Which windows of the strings occur in another string of their group at the same distance from the anchor.

    ``at`` is the distance of a string's anchor from its start, ``group`` the group's number, in order. Returns rows
    (string, first window, windows).

    Each round inserts the next symbol to the left of every string that has one: a stable sort by symbol within the
    groups turns the order of the suffixes from the column before into the order of this one, and two neighbours with
    the same symbol share one byte more than the least that any two between them shared before.
    """
    length = np.array([len(s) for s in strings])
    right, left = length - at, -at  # columns of a string: [left, right), its anchor at 0
    first, last = int(left.min()), int(right.max())
    columns = np.zeros((last - first, len(strings)), np.uint8)
    for i, s in enumerate(strings):
        columns[left[i] - first : right[i] - first, i] = np.frombuffer(s, np.uint8)
    by_end = np.argsort(-right, kind="stable")
    begins = np.searchsorted(-right[by_end], -np.arange(first, last + 1)[::-1], "right")  # strings in by column
    begins = dict(zip(range(last, first - 1, -1), begins.tolist()))
    leaving = np.bincount(left - first, minlength=last - first + 1)
    found: list[tuple[np.ndarray, int]] = []
    order, shared, entered = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    base = group.astype(np.int64) << 8
    for column in range(last - 1, first - 1, -1):
        if begins[column + 1] > entered:  # their suffix so far is empty: first in the order, nothing shared
            new = by_end[entered : begins[column + 1]]
            entered = begins[column + 1]
            order, shared = np.concatenate([new, order]), np.concatenate([np.zeros(len(new), np.int64), shared])
        if not len(order):
            continue
        key = base[order] | columns[column - first][order]
        by = np.argsort(key, kind="stable")
        key = key[by]
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        lo, hi = by[same - 1], by[same]
        least = shared[hi]
        gaps = np.flatnonzero(hi != lo + 1)
        if len(gaps):
            bounds = np.empty(2 * len(gaps), np.int64)
            bounds[0::2], bounds[1::2] = lo[gaps] + 1, hi[gaps] + 1
            least[gaps] = np.minimum.reduceat(np.append(shared, 0), bounds)[::2]
        order = order[by]
        shared = np.zeros(len(order), np.int64)
        shared[same] = least + 1
        long = shared >= min_bytes
        if long.any():
            found.append((order[long | np.append(long[1:], False)], column))
        if leaving[column - first]:
            keep = np.flatnonzero(left[order] < column)
            if len(keep):
                shared = np.minimum.reduceat(shared[: keep[-1] + 1], np.append(0, keep[:-1] + 1))
                shared[0] = 0
            else:
                shared = shared[:0]
            order = order[keep]
    if not found:
        return np.zeros((0, 3), np.int64)
    which = np.concatenate([w for w, _ in found])
    window = np.concatenate([np.full(len(w), c) for w, c in found]) + at[which]
    by = np.lexsort((window, which))
    which, window = which[by], window[by]
    run = np.flatnonzero(np.append(True, (np.diff(which) != 0) | (np.diff(window) != 1)))
    return np.stack([which[run], window[run], np.diff(np.append(run, len(which)))], axis=1)


_SPANS = "a long, b long, start long, windows long"
_TEXTS = "a long, b long, start long, windows int, at int, key long, content long, copies long, piece binary"


def _rounds(min_bytes: int, width: int):
    """Spans of the pieces with one copy, for batches sorted by key; groups stay whole across batches."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        group = (rows["key"].to_numpy()[1:] != rows["key"].to_numpy()[:-1]).cumsum()
        at = width * rows["at"].to_numpy(np.int64)
        hits = column_rounds(rows["piece"].tolist(), at, np.append(0, group), width * min_bytes)
        hits = hits[rows["copies"].to_numpy()[hits[:, 0]] == 1]
        first = -(-hits[:, 1] // width)  # windows that start inside a symbol do not count
        windows = (hits[:, 1] + hits[:, 2] - 1) // width - first + 1
        hits, first, windows = hits[windows > 0], first[windows > 0], windows[windows > 0]
        of = rows.iloc[hits[:, 0]]
        return pd.DataFrame(
            {"a": of["a"].to_numpy(), "b": of["b"].to_numpy(), "start": of["start"].to_numpy() + first, "windows": windows}
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += int(batch["piece"].str.len().sum())
            if size < BLOCK_BYTES:
                continue
            rows = pd.concat(held, ignore_index=True)
            key = rows["key"].to_numpy()
            cut = int(np.flatnonzero(key == key[-1])[0])  # the last group may go on
            if cut:
                yield work(rows.iloc[:cut])
            held = [rows.iloc[cut:]]
            size = int(held[0]["piece"].str.len().sum())
        if held and sum(map(len, held)):
            yield work(pd.concat(held, ignore_index=True))

    return run


def _slices(min_bytes: int, encode: Callable[[str], bytes], width: int):
    """The bytes of the wanted pieces, for batches of (text, pieces)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, a, b, pieces in zip(batch["text"], batch["a"], batch["b"], batch["pieces"]):
                data = encode(text)
                for p in pieces:
                    rows.append((a, b, p["start"], p["windows"], p["at"], p["key"], p["content"], p["copies"],
                                 data[width * p["start"] : width * (p["start"] + p["windows"] + min_bytes - 1)]))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _TEXTS.split(", ")])

    return run


def _crowded(pieces: DataFrame, min_bytes: int, width: int) -> DataFrame:
    """The spans of groups with very many different pieces: their windows are counted by a 128-bit hash, with partial
    sums before the shuffle, so that no task ever holds such a group."""

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                n = row.windows
                digests = [xxhash.xxh3_128_digest(row.piece[width * i : width * (i + min_bytes)]) for i in range(n)]
                pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pd.DataFrame({"h": pair[:, 0], "g": pair[:, 1], "a": row.a, "b": row.b,
                                    "start": row.start + np.arange(n), "copies": row.copies})

    found = pieces.mapInPandas(windows, "h long, g long, a long, b long, start long, copies long")
    often = found.groupBy("h", "g").agg(F.count("*").alias("n")).where("n > 1").select("h", "g")
    return found.where("copies = 1").join(often, ["h", "g"], "left_semi").select(
        "a", "b", "start", F.lit(1).cast("long").alias("windows")
    )


def identified(docs: DataFrame, column: str = "text") -> DataFrame:
    """Adds ``a, b``: a 128-bit identity of the text, so equal texts are one string with equal spans."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return docs.withColumns({"text": text, "a": F.xxhash64(text), "b": F.xxhash64(F.lit(1), text)})


def repeated_windows(
    texts: DataFrame,
    *,
    min_bytes: int = MIN_BYTES,
    anchor_bytes: int = ANCHOR_BYTES,
    group_pieces: int = GROUP_PIECES,
    encode: Callable[[str], bytes] = utf8,
    width: int = 1,
) -> DataFrame:
    """Spans ``a, b, start, windows`` of windows that occur elsewhere: the ``min_bytes`` bytes at each of ``windows``
    starts from ``start`` on. ``texts`` has ``a, b, text`` of ``identified``, with copies. With a ``width``, the symbols
    that ``encode`` gives have that many bytes, and all lengths and positions are in symbols.

    Only hashes of the pieces are shuffled for all texts; the bytes follow for one piece of each different content
    whose anchor others share, from texts that have such pieces (``sifted``): copies and unrelated texts stay where
    they are.
    """
    pieces = staged(texts.select("a", "b", "text").mapInArrow(_index(Anchors(min_bytes, anchor_bytes, width), encode), _PIECES), "pieces")
    # Stored, like the groups below: a join right after the aggregation would use its shuffle, and a hot anchor's pieces
    # could not be split.
    anchors = staged(
        pieces.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("content").alias("lo"), F.max("content").alias("hi"))
        .where("n > 1")
        .select("key", (F.col("lo") != F.col("hi")).alias("mixed")),
        "anchors",
    )
    shared = staged(pieces.join(anchors, "key"), "shared")
    alike = shared.where("NOT mixed").select("a", "b", "start", F.col("windows").cast("long"))
    mixed = shared.where("mixed")
    contents = staged(
        mixed.groupBy("key", "content").agg(
            F.count("*").alias("copies"), F.min(F.struct("a", "b", "start", "windows", "at")).alias("one")
        ),
        "contents",
    )
    # Contents that hold a large share of all pieces (a passage everywhere, a text that repeats itself) are few, and
    # found without a shuffle, so that none of them fills a task.
    total = contents.agg(F.sum("copies")).first()[0] or 0
    by = ["key", "content"]
    hot = F.broadcast(contents.where(F.col("copies") > max(1, total // HOT_CONTENTS)).select(by))
    others = contents.where(F.col("copies").between(2, max(1, total // HOT_CONTENTS))).select(by)
    copied = (
        mixed.join(hot, by, "left_semi")
        .unionByName(mixed.join(hot, by, "left_anti").join(others, by, "left_semi"))
        .select("a", "b", "start", F.col("windows").cast("long"))
    )
    # Contents of one key that are all copied need no rounds, nor do keys where nothing is single.
    groups = contents.groupBy("key").agg(F.count("*").alias("members"), F.min("copies").alias("fewest"))
    groups = staged(groups.where("members > 1 AND fewest = 1"), "groups")
    wanted = staged(
        contents.join(groups, "key")
        .select("one.*", "key", "content", "copies", "members")
        .groupBy("a", "b")
        .agg(F.collect_list(F.struct("start", "windows", "at", "key", "content", "copies", "members")).alias("pieces")),
        "wanted",
    )
    likely = sifted(texts.select("a", "b", "text"), wanted, "a", "likely").where("likely")
    source = likely.groupBy("a", "b").agg(F.first("text").alias("text"))
    columns = f"{_TEXTS}, members long"
    cut = _slices(min_bytes, encode, width)

    def cuts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for out, members in zip(cut([batch]), [[p["members"] for ps in batch["pieces"] for p in ps]]):
                yield out.assign(members=members)

    found = source.join(wanted, ["a", "b"]).select("a", "b", "text", "pieces").mapInPandas(cuts, columns)
    bytes_of = staged(found, "bytes")
    usual = bytes_of.where(F.col("members") <= group_pieces).drop("members")
    crowded = bytes_of.where(F.col("members") > group_pieces).drop("members")
    rounds = usual.repartition("key").sortWithinPartitions("key").mapInPandas(_rounds(min_bytes, width), _SPANS)
    return alike.unionByName(copied).unionByName(rounds).unionByName(_crowded(crowded, min_bytes, width))


def _by_text(windows: DataFrame) -> DataFrame:
    return windows.groupBy("a", "b").agg(F.collect_set(F.struct("start", "windows")).alias("spans"))


def without_repeats(docs: DataFrame, column: str = "text", *, min_bytes: int = MIN_BYTES, **options: int) -> DataFrame:
    """``docs`` with ``n_bytes``, ``removed`` (the maximal removed runs as structs of start and end, in bytes) and
    ``kept`` (the remaining bytes, concatenated; removal may cut a character). Input columns of these names, and of the
    temporary names ``a, b, spans``, are replaced or dropped.

    A byte goes if a string of ``min_bytes`` bytes that covers it starts anywhere else, in any text or the same one.
    Null texts are empty; texts shorter than that keep everything; of equal longer texts nothing is left. Every row
    gives a row; an empty table gives none. Texts are joined with their spans by their identity, an equi-join in which
    adaptive execution splits a hot one; only texts that may have spans are moved for it (``sifted``).
    """
    mark = stored_so_far()
    texts = identified(docs.drop("n_bytes", "removed", "kept", "spans"), column)
    windows = repeated_windows(texts, min_bytes=min_bytes, **options)
    spans = staged(_by_text(windows), "spans", since=mark)

    @arrow_udf("n_bytes long, removed array<struct<start:long,end:long>>, kept binary")
    def cut(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, lists in columns:
            yield pa.array(
                [_cut(utf8(t.as_py()), s.as_py(), min_bytes) for t, s in zip(text, lists)],
                pa.struct([("n_bytes", pa.int64()),
                           ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                           ("kept", pa.binary())]),
            )

    likely = unused(texts, "_likely")
    sieved = sifted(texts, spans, "a", likely)
    met = sieved.where(likely).join(spans, ["a", "b"], "left")
    unmet = sieved.where(~F.col(likely)).withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    joined = met.unionByName(unmet).withColumn(found := unused(docs, "_cut"), cut("text", "spans"))
    extra = [c for c in docs.columns if c not in {"n_bytes", "removed", "kept", "spans", "a", "b"}]
    return joined.select(*extra, f"{found}.*")


def repeated_passages(
    docs: DataFrame, column: str = "text", *, min_words: int = MIN_WORDS, anchor_words: int = ANCHOR_WORDS, **options: int
) -> DataFrame:
    """Rows ``a, b, passages`` for the texts, by their identity (``identified``), in which ``min_words`` words also start
    anywhere else, in any text or the same one: the maximal runs of words so covered, as structs of start and end.

    Words are ``[^\\x20\\x09-\\x0D]+``, compared as they are by 64-bit hashes, whatever the white space between them.
    Equal texts of several rows are elsewhere for one another, and have one row here. Null texts are empty; an empty
    table gives no rows.
    """
    mark = stored_so_far()
    windows = repeated_windows(identified(docs, column), min_bytes=min_words, anchor_bytes=anchor_words,
                               encode=word_hashes, width=WORD_BYTES, **options)

    @arrow_udf("array<struct<start:long,end:long>>")
    def merged(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in columns:
            runs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.array([_runs(s.as_py(), min_words) for s in lists], runs)

    return staged(_by_text(windows).select("a", "b", merged("spans").alias("passages")), "passages", since=mark)


def _runs(spans: list[dict], min_bytes: int) -> list[dict]:
    runs: list[dict] = []
    for start, end in sorted((s["start"], s["start"] + s["windows"] + min_bytes - 1) for s in spans):
        if runs and start <= runs[-1]["end"]:
            runs[-1]["end"] = max(end, runs[-1]["end"])
        else:
            runs.append({"start": start, "end": end})
    return runs


def _cut(data: bytes, spans: list[dict] | None, min_bytes: int) -> dict:
    if not spans:
        return {"n_bytes": len(data), "removed": [], "kept": data}
    removed = _runs(spans, min_bytes)
    at, kept = 0, []
    for run in removed:
        kept.append(data[at : run["start"]])
        at = run["end"]
    return {"n_bytes": len(data), "removed": removed, "kept": b"".join([*kept, data[at:]])}


def op10_repeats(spark: SparkSession, root: str) -> DataFrame:
    """What is removed, in bytes; and the words in passages of over 50 words that occur elsewhere, which removal leaves
    where they have fewer bytes than a string that counts."""
    docs = table(spark, root, "documents").select("doc_id", "text")
    passages = repeated_passages(docs).withColumnsRenamed({"a": "text_a", "b": "text_b"})
    named = identified(docs).withColumnsRenamed({"a": "text_a", "b": "text_b"})
    found = without_repeats(named).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        "text_a",
        "text_b",
    )
    words = F.aggregate("passages", F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["start"])
    return found.join(passages, ["text_a", "text_b"], "left").select(
        *found.columns[:-2],
        F.coalesce(words, F.lit(0)).alias("n_passage_words"),
        F.when(F.col("passages").isNull(), 0).otherwise(F.size("passages")).cast("long").alias("n_passages"),
    )
