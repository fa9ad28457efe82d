"""Quality classifier: learned hashed word and character n-gram vectors, averaged per document, with a softmax output."""

from __future__ import annotations

from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shelfcast.llm.common import staged, table

BUCKETS = 1 << 16
SIZES = (3, 4, 5)  # bytes of an n-gram
DIMENSION = 16
EPOCHS = 6
RATE, VECTOR_RATE = 0.2, 40.0  # a vector moves by its share of the document, so it needs larger steps
TRAIN_ROWS = 4000  # labelled documents that the model is fitted on, at most
TRAIN_BYTES = 16 << 20  # and of their texts, where a text counts with BUCKETS bytes at most, as its n-grams fill no more buckets
THRESHOLD = 0.3
PART = 1 << 20  # bytes hashed at once
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
REPEATED = np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int64)


def _buckets_of(data: np.ndarray, before: np.ndarray) -> Generator[np.ndarray, None, np.ndarray]:
    """Buckets of all words, pairs of words and n-grams, of bytes in which white space is single spaces, one at either end.

    ``before`` has the word before them, if there is one; returns the last word in the same form.
    """
    space = data == 32
    wide = data.astype(np.uint64)
    value = wide.copy()
    inner = np.zeros(len(data), np.int64)
    edges = np.append(0, np.cumsum(space))
    for n in range(2, max(SIZES) + 1):
        if n > len(data):
            break
        value = value[:-1] * np.uint64(257) + wide[n - 1 :]
        if n in SIZES:
            # no word boundary inside; a space at an end marks where a word begins or ends
            count = len(data) - n + 1
            inner = edges[n - 1 : n - 1 + count] - edges[1 : 1 + count]
            yield _mixed(value[inner == 0] * np.uint64(8) + np.uint64(n))
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    if len(starts):
        ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        # a polynomial in the place inside the word, so that the sums of a word need no other
        place = np.arange(len(data)) - np.repeat(np.append(0, starts), np.diff(np.append(np.append(0, starts), len(data))))
        power = WORD_BASE ** np.minimum(place + 1, 1 << 20).astype(np.uint64)
        sums = np.append(np.uint64(0), np.cumsum((wide + np.uint64(1)) * power))
        word = sums[ends] - sums[starts]
        yield _mixed(word)
        # pairs of words; a word after itself is one and the same pair for all words
        chain = np.append(before, word)
        pair = chain[:-1] * np.uint64(31) + chain[1:]
        yield _mixed(np.where(chain[:-1] == chain[1:], REPEATED, pair))
        before = word[-1:]
    return before


def _bounded(words: list[bytes]) -> Iterator[bytes]:
    for word in words:
        for at in range(0, len(word), PART // 2):
            yield word[at : at + PART // 2]


def buckets(text: str | None) -> Iterator[np.ndarray]:
    """The buckets of a whole text, in parts of bounded size. A word of more than half a part is taken as several words."""
    words = (text or "").encode("utf-8", "replace").split()
    if not words:
        return
    if max(map(len, words)) > PART // 2:
        words = list(_bounded(words))
    joined = b" " + b" ".join(words) + b" "
    at, last = 0, np.zeros(0, np.uint64)
    while at < len(joined) - 1:
        end = min(at + PART, len(joined))
        if end < len(joined):
            end = joined.rfind(b" ", at + 1, end) + 1  # there is one, as no word fills the part
        last = yield from _buckets_of(np.frombuffer(joined[at:end], np.uint8), last)
        at = end - 1


def shares(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The different buckets of a text, and the share of its words and n-grams that each has."""
    count = np.zeros(BUCKETS, np.int64)
    for part in buckets(text):
        count += np.bincount(part, minlength=BUCKETS)
    index = np.flatnonzero(count)
    return index.astype(np.int32), (count[index] / max(1, count.sum())).astype(np.float32)


def packed(text: str | None) -> tuple[bytes, bytes, bool]:
    """The different buckets of a text (two bytes each) and their counts, in one byte each if all fit, else in four."""
    count = np.zeros(BUCKETS, np.int64)
    for part in buckets(text):
        count += np.bincount(part, minlength=BUCKETS)
    index = np.flatnonzero(count)
    small = not len(index) or int(count.max()) < 256
    return index.astype(np.uint16).tobytes(), count[index].astype(np.uint8 if small else np.uint32).tobytes(), small


class Rows(Sequence):
    """Packed documents, as the pairs of ``shares`` only when they are read."""

    def __init__(self, data: list[tuple[bytes, bytes, bool]]) -> None:
        self.data = data

    def __len__(self) -> int:
        return len(self.data)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        index, count, small = self.data[i]
        count = np.frombuffer(count, np.uint8 if small else np.uint32)
        total = count.sum(dtype=np.int64)
        return np.frombuffer(index, np.uint16).astype(np.int32), (count / max(1, total)).astype(np.float32)


@dataclass
class Model:
    """What scoring needs: with a linear output, a bucket counts with one number, its vector times the output weights."""

    weight: np.ndarray  # per bucket: log odds for label 1
    bias: float

    def score(self, text: str | None) -> float:
        total, n = 0.0, 0
        for part in buckets(text):
            total += float(self.weight[part].sum(dtype=np.float64))
            n += len(part)
        return float(1 / (1 + np.exp(-np.clip(total / max(1, n) + self.bias, -40, 40))))


def train(
    rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, dimension: int = DIMENSION, epochs: int = EPOCHS, seed: int = 5
) -> Model:
    """Stochastic gradient descent over documents (buckets, shares) in random order, with a falling rate.

    No rows give a score of one half, one class a constant score.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, dimension)).astype(np.float32) / dimension
    output = np.zeros((dimension, 2), np.float32)
    bias = np.zeros(2, np.float32)
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            index, share = rows[i]
            fall = 1 - done / steps
            done += 1
            hidden = share @ vectors[index]
            logits = hidden @ output + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[int(labels[i])] -= 1
            back = output @ error
            output -= RATE * fall * np.outer(hidden, error)
            bias -= RATE * fall * error
            vectors[index] -= np.float32(VECTOR_RATE * fall) * np.outer(share, back)
    odds = vectors @ (output[:, 1] - output[:, 0])
    return Model(odds.astype(np.float32), float(bias[1] - bias[0]))


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: CRC-32 of its id as text (null: empty) is a multiple of five."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, *, target: str = "quality", rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> Model:
    """A model from the labelled documents that are not held out.

    At most ``rows`` of them, chosen by a hash of the id, and of these, in that order, all that still fit into ``size``
    bytes together, where a text counts with ``BUCKETS`` bytes at most: one that does not fit shuts out no other. Labels
    without id or value are left out; of repeated rows of an id one is used. Their n-grams are counted on the executors.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & ~held_out())
    order = F.xxhash64("doc_id")
    chosen = usable.groupBy("doc_id").agg(F.max(target).alias("label")).orderBy(order, "doc_id").limit(rows)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # bounded by ``rows``
    found = staged(texts.join(F.broadcast(staged(chosen, "labels")), "doc_id").dropDuplicates(["doc_id"]), "labelled")
    lengths = found.select("doc_id", order.alias("h"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).toPandas().sort_values(["h", "doc_id"])
    taken, used = [], 0
    for doc_id, n in zip(lengths["doc_id"].tolist(), lengths["n"].tolist()):
        cost = min(n, BUCKETS)
        if used + cost <= size:
            taken.append((doc_id,))
            used += cost
    id_type = found.schema["doc_id"].dataType.simpleString()
    kept = docs.sparkSession.createDataFrame(taken, f"doc_id {id_type}")
    found = found.join(F.broadcast(kept), "doc_id", "left_semi")  # bounded by ``rows``

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [packed(text) for text in batch["text"]]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "label": batch["label"], "index": [i for i, _, _ in out],
                 "count": [c for _, c, _ in out], "small": [b for _, _, b in out]}
            )

    data = found.mapInPandas(counted, f"doc_id {id_type}, label int, index binary, count binary, small boolean").toPandas()
    data = data.sort_values("doc_id")
    return train(Rows(list(zip(data["index"], data["count"], data["small"]))), data["label"].to_numpy())


def score(docs: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 is likelier); an input column of that name is replaced.

    Null and empty texts get the score of the bias alone. Only the text is read: equal texts get equal scores, no shuffle,
    an empty table gives no rows. The model is a table of ``BUCKETS`` numbers, whatever the corpus.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))

    @arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Model(*shared.value)
        for texts in batches:
            yield pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    return docs.withColumn("score", scores(F.col(column).cast("string")))


def op9_quality(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, root, "labels"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
