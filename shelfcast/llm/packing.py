"""Token ids in packed matrices: best-fit-decreasing packing of tokenised documents into rows of equal length."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import table

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's authors split text before the merges (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_ID = 50256  # free in the vocabulary: ends every document, and fills rows
LENGTH = 2048
BLOCK_TOKENS = 1 << 21  # documents of a partition that are packed together
PART_CHARS = 1 << 21  # text tokenised at once

#: Where a text may be cut without changing its tokens: at a space between two characters that are no white space.
CUT = re.compile(r"(?<=\S) (?=\S)")

class Tokens:
    """Token ids of texts, equal to those of the tokenizer on the whole text; long texts are tokenised in parts."""

    def __init__(self, ranks: bytes) -> None:
        merges = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})

    def of(self, text: str) -> np.ndarray:
        parts, at = [], 0
        while at < len(text):
            found = CUT.search(text, at + PART_CHARS) if len(text) - at > PART_CHARS else None
            end = found.start() if found else len(text)
            parts.append(np.array(self.encoding.encode_ordinary(text[at:end]), np.int32))
            at = end
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.int32), *parts])


class Capacities:
    """Open rows by free places: a segment tree over 0..length that finds the least sufficient one."""

    def __init__(self, length: int) -> None:
        self.width = 1 << length.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        node = free + self.width
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The free places and the number of the fullest row with at least ``need`` of them; it is removed."""
        node = need + self.width
        while not self.count[node]:
            while node & 1:  # a right child, or the root: nothing larger below this parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.width:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        free = node - self.width
        while node:
            self.count[node] -= 1
            node >>= 1
        return free, self.rows[free].pop()


def pack(lengths: np.ndarray, length: int) -> list[list[tuple[int, int, int]]]:
    """Rows of segments (document, start, end) by best-fit decreasing.

    A document longer than a row fills whole rows, and its rest is packed like a short one. Longest segments first, ties in
    order; each goes to the row with the least free places that suffice, the one opened last among equals.
    """
    rows: list[list[tuple[int, int, int]]] = []
    rests: list[tuple[int, int, int]] = []
    for i, n in enumerate(lengths.tolist()):
        at = 0
        while n - at >= length:
            rows.append([(i, at, at + length)])
            at += length
        if at < n:
            rests.append((i, at, n))
    open_rows = Capacities(length)
    for segment in sorted(rests, key=lambda s: s[1] - s[2]):
        size = segment[2] - segment[1]
        found = open_rows.take(size)
        if found is None:
            rows.append([segment])
            free, row = length, len(rows) - 1
        else:
            free, row = found
            rows[row].append(segment)
        if free > size:
            open_rows.add(free - size, row)
    return rows


def _schema(id_type: str) -> str:
    return (
        f"pack long, ids binary, positions binary, cu_seqlens array<int>, doc_ids array<{id_type}>, starts array<int>, n_tokens int"
    )


COLUMNS = ["pack", "ids", "positions", "cu_seqlens", "doc_ids", "starts", "n_tokens"]


def _packed(number: int, documents: list[tuple], length: int, end_id: int, id_type: pa.DataType) -> pa.RecordBatch:
    lengths = np.array([len(t) for _, t in documents], np.int64)
    columns: list[list] = [[] for _ in range(7)]
    for i, segments in enumerate(pack(lengths, length)):
        ids, positions = np.full(length, end_id, "<i4"), np.zeros(length, "<i4")
        bounds = [0]
        for document, start, end in segments:
            at = bounds[-1]
            ids[at : at + end - start] = documents[document][1][start:end]
            positions[at : at + end - start] = np.arange(end - start)
            bounds.append(at + end - start)
        positions[bounds[-1] :] = np.arange(length - bounds[-1])
        row = (number + i, ids.tobytes(), positions.tobytes(), bounds, [documents[d][0] for d, _, _ in segments],
               [s for _, s, _ in segments], bounds[-1])
        for column, value in zip(columns, row):
            column.append(value)
    types = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(id_type), pa.list_(pa.int32()), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], COLUMNS)


def packed(
    docs: DataFrame,
    ranks: str = RANKS,
    *,
    length: int = LENGTH,
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The token ids of ``docs`` (``doc_id, text``; other columns are ignored), packed into rows of ``length`` ids.

    ``ids`` and ``positions`` are rows of matrices, little-endian 32-bit integers: token ids, filled up with ``end_id``, and
    places that start again at 0 with each segment and with the filling. ``cu_seqlens`` are the cumulative lengths of the
    segments, from 0; ``doc_ids`` and ``starts`` say which document each is from and at which of its tokens it begins (a
    document's segments in order of ``starts`` are its tokens); ``n_tokens`` is without the filling; ``pack`` numbers rows.

    Every document ends with ``end_id``, so null and empty texts are one token, and no row of the input is lost; repeated rows
    are packed each; an empty table gives no rows; ids keep their type. Nothing is shuffled: a task packs the documents of its partition in
    blocks of about ``block_tokens`` tokens, so it holds one block, and a lost task is repeated from its own input. Rows that
    are not full remain only at the end of a block. ``ranks`` (a vocabulary file) is read on the driver and sent along.
    """
    with open(ranks, "rb") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(vocabulary.value)
        number = TaskContext.get().partitionId() << 40
        held: list[tuple] = []
        size, kind = 0, pa.int64()
        for batch in batches:
            kind = batch.column(0).type
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(tokens.of(text.as_py() or ""), np.int32(end_id))
                held.append((name, ids))
                size += len(ids)
                if size >= block_tokens:
                    out = _packed(number, held, length, end_id, kind)
                    number += out.num_rows
                    held, size = [], 0
                    yield out
        if held:
            yield _packed(number, held, length, end_id, kind)

    schema = _schema(docs.schema["doc_id"].dataType.simpleString())
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def op3_packing(spark: SparkSession, root: str) -> DataFrame:
    return packed(table(spark, root, "documents"))


def stage(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    """Last pipeline stage: packed token ids."""
    return packed(docs)
