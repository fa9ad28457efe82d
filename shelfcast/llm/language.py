"""Language identification: sparse multinomial logistic regression on TF-IDF weights of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shelfcast.llm.common import staged, table

BUCKETS = 1 << 16  # of hashed n-grams
LONGEST = 4  # characters of an n-gram
TRAIN_ROWS = 4000  # texts that the model is fitted on, at most, an equal share of each language
TRAIN_NGRAMS = 24 << 20  # and of their n-grams, where a text counts with BUCKETS at most
CALIBRATION = 8  # one of so many of them sets the temperature, and is not learned from
EPOCHS = 3
RATE, RATE_OFFSET, L1, L2 = 1.0, 1.0, 0.01, 0.001
PART = 1 << 20  # characters hashed at once
UNDETERMINED = "und"
MIX = np.uint64(0x9E3779B97F4A7C15)


def _codes(text: str) -> np.ndarray:
    """Code points in lower case, with every run of ASCII characters that are no letters as one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    space = (codes < 128) & ((codes < 97) | (codes > 122))
    codes = np.where(space, np.uint32(32), codes)
    return codes[~(space & np.append(False, space[:-1]))]


def buckets(text: str | None) -> Iterator[np.ndarray]:
    """The buckets of all n-grams of a whole text with a space at either end, in parts of bounded size.

    N-grams have 1 to ``LONGEST`` characters; a space stands only at their ends, so they say where a word begins and ends,
    but not what stands beside it.
    """
    text = text or ""
    before = np.array([32], np.uint32)
    for at in range(0, len(text) + 1, PART):
        part = _codes(text[at : at + PART] + " " * (at + PART > len(text)))
        if len(part) and part[0] == 32 and before[-1] == 32:
            part = part[1:]
        codes = np.append(before, part)
        wide = codes.astype(np.uint64) + np.uint64(1)
        inner = np.append(0, np.cumsum(codes == 32))
        value = wide.copy()
        for n in range(1, LONGEST + 1):
            if n > len(codes):
                break
            if n > 1:
                value = value[:-1] * np.uint64(0x100000001B3) + wide[n - 1 :]
            first = max(0, len(before) - n + 1)  # those that end in what was there before are counted
            some = value[first:]
            if n == 1:
                some = some[codes[first:] != 32]
            elif n > 2:
                count = len(codes) - n + 1
                some = some[(inner[n - 1 : n - 1 + count] - inner[1 : 1 + count])[first:] == 0]
            mixed = (some + np.uint64(n)) * MIX
            yield ((mixed ^ (mixed >> np.uint64(29))) * MIX >> np.uint64(48)).astype(np.uint16)
        before = codes[-(LONGEST - 1) :] if LONGEST > 1 else codes[-1:]


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The different buckets of a text and how often each occurs."""
    if len(text or "") < PART // 16:
        found = np.sort(np.concatenate(list(buckets(text)) or [np.zeros(0, np.uint16)]), kind="stable")
        ends = np.append(np.flatnonzero(found[1:] != found[:-1]) + 1, len(found)) if len(found) else np.zeros(0, np.int64)
        return found[ends - 1].astype(np.int32), np.diff(ends, prepend=0)
    count = np.zeros(BUCKETS, np.int64)
    for part in buckets(text):
        count += np.bincount(part, minlength=BUCKETS)
    index = np.flatnonzero(count)
    return index.astype(np.int32), count[index]


def weights(index: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of unit length, with the logarithm of the counts."""
    value = (1 + np.log(count)) * idf[index]
    return (value / max(np.sqrt(value @ value), 1e-12)).astype(np.float32)


def _softmax(logits: np.ndarray) -> np.ndarray:
    odds = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return odds / odds.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    place: np.ndarray  # per bucket: its row in ``weight``, 0 for those without weight
    weight: np.ndarray  # rows of a number per language; the first is zero
    bias: np.ndarray
    temperature: float

    def logits(self, index: np.ndarray, count: np.ndarray) -> np.ndarray:
        rows = self.place[index]
        used = rows > 0
        return weights(index, count, self.idf)[used] @ self.weight[rows[used]] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not any(map(str.isalpha, text or "")):
            return UNDETERMINED, 0.0
        odds = _softmax(self.logits(*counted(text)) / self.temperature)
        best = int(odds.argmax())
        return self.languages[best], float(odds[best])


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, *, epochs: int = EPOCHS, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Weights (bucket by class) and biases by the follow-the-regularised-leader rule with elastic-net penalties.

    ``rows`` are buckets and TF-IDF weights. Per weight the rule keeps a sum of gradients ``z`` and of their squares ``n``; a weight
    whose sum stays within ``L1`` is exactly zero. Biases are not penalised.
    """
    z, n = np.zeros((BUCKETS, classes), np.float32), np.zeros((BUCKETS, classes), np.float32)
    zb, nb = np.zeros(classes), np.zeros(classes)

    def leader(z: np.ndarray, n: np.ndarray, l1: float, l2: float) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0, (np.sign(z) * l1 - z) / ((RATE_OFFSET + np.sqrt(n)) / RATE + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            index, x = rows[i]
            w, bias = leader(z[index], n[index], L1, L2), leader(zb, nb, 0, 0)
            error = _softmax(x @ w + bias)
            error[labels[i]] -= 1
            g = np.outer(x, error)
            z[index] += g - (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / RATE * w
            n[index] += g * g
            zb += error - (np.sqrt(nb + error * error) - np.sqrt(nb)) / RATE * bias
            nb += error * error
    return leader(z, n, L1, L2).astype(np.float32), leader(zb, nb, 0, 0)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss on these rows, by golden section between 1/20 and 20; 1 without rows.

    Of n rows, one in n + 2 counts as wrong, so that rows without an error don't make every probability one.
    """
    if not len(logits) or logits.shape[1] < 2:
        return 1.0
    doubt = 1 / (len(logits) + 2)

    def loss(t: float) -> float:
        odds = np.log(np.maximum(_softmax(logits / np.exp(t)), 1e-300))
        right = odds[np.arange(len(labels)), labels]
        wrong = (odds.sum(axis=1) - right) / (logits.shape[1] - 1)
        return -float(((1 - doubt) * right + doubt * wrong).mean())

    low, high, part = -np.log(20), np.log(20), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: CRC-32 of its id as text (null: empty) leaves 2 when divided by four."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts of the column ``text`` each bucket occurs, and the number of texts. Tasks add up their texts, so at most
    ``BUCKETS`` numbers leave a task, and ``BUCKETS`` reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for text in batch.column(0):
                found[counted(text.as_py())[0]] += 1
        index = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(index, -1), pa.int32()), pa.array(np.append(found[index], rows))], ["bucket", "n"]
        )

    sums = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS + 1, np.int64)
    out[sums["bucket"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)  # -1: the last place
    return out[:-1], int(out[-1])


def fit(docs: DataFrame, *, rows: int = TRAIN_ROWS, ngrams: int = TRAIN_NGRAMS) -> Model:
    """A model from ``text`` and ``lang`` of the documents that are not held out and have a language.

    Document frequencies are those of all of them. The weights are fitted on different texts, ``rows`` at most, chosen by a hash of the text,
    equally many per language as far as there are; of these, in that order, all that still fit into ``ngrams``, where a
    text counts with ``BUCKETS`` at most, so that a long one shuts out no other. Their n-grams are counted on the executors. Texts without a language
    (null) teach nothing; the text itself may be null or empty.
    """
    usable = docs.where(F.col("lang").isNotNull() & ~held_out()).select(
        F.col("lang").cast("string").alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    frequency, n = document_frequencies(usable)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    key = F.xxhash64("text").alias("h")
    texts = staged(usable.groupBy("lang", key).agg(F.min(F.length("text")).alias("n")), "different-texts")
    # One of so many texts of a language by hash: about four times ``rows`` of them are ranked, however many there are.
    share = F.ceil(F.count("*") / F.lit(4 * rows)).alias("share")
    # Stored, so that Spark knows the size: shares of a few languages are broadcast, and texts are filtered where they lie.
    shares = staged(texts.groupBy("lang").agg(share), "shares")
    some = texts.join(shares, "lang").where(F.pmod(F.xxhash64("h"), F.col("share")) == 0)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("h"), "h"))
    ranked = some.withColumn("place", place).where(F.col("place") <= rows)
    taken, used = [], 0
    for r in ranked.orderBy("place", "lang").limit(rows).collect():
        cost = min(LONGEST * r["n"], BUCKETS)
        if used + cost <= ngrams:
            taken.append((r["lang"], r["h"], len(taken)))
            used += cost
    # bounded by ``rows``
    chosen = F.broadcast(docs.sparkSession.createDataFrame(taken, "lang string, h long, place int"))
    found = staged(usable.withColumn("h", key).join(chosen, ["lang", "h"]).dropDuplicates(["place"]), "languages")

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [counted(text) for text in batch["text"]]
            yield pd.DataFrame({"place": batch["place"], "lang": batch["lang"], "index": [i.astype(np.int32).tobytes() for i, _ in out],
                                "count": [c.astype(np.int32).tobytes() for _, c in out]})

    data = found.select("text", "lang", "place").mapInPandas(packed, "place int, lang string, index binary, count binary").toPandas()
    data = data.sort_values("place")
    languages = sorted(data["lang"].unique().tolist())
    labels = np.searchsorted(languages, data["lang"]) if len(data) else np.zeros(0, np.int64)
    vectors = []
    for index, count in zip(data["index"], data["count"]):
        index = np.frombuffer(index, np.int32)
        vectors.append((index, weights(index, np.frombuffer(count, np.int32), idf)))
    # one of each language in turn, so that every one has rows to calibrate with
    calibrates = (data["place"].to_numpy(np.int64) // max(1, len(languages))) % CALIBRATION == CALIBRATION - 1
    learn = [i for i in range(len(vectors)) if not calibrates[i]]
    weight, bias = train([vectors[i] for i in learn], labels[learn], len(languages))
    has = (weight != 0).any(axis=1)
    kept = np.concatenate([np.zeros((1, len(languages)), np.float32), weight[has]])
    logits = np.array([vectors[i][1] @ weight[vectors[i][0]] + bias for i in np.flatnonzero(calibrates)])
    return Model(languages, idf.astype(np.float32), np.where(has, np.cumsum(has), 0).astype(np.int32), kept, bias,
                 temperature(logits, labels[calibrates]))


def identify(docs: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, its calibrated probability; input columns of these names are replaced.

    ``und`` with score 0 where the text is null or has no letter, and where nothing was learned. Only the text is read: equal texts get
    equal results, no shuffle, an empty table gives no rows. The model is sent to every task: ``BUCKETS`` numbers, and for those n-grams that have weights one
    per language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.idf, model.place, model.weight, model.bias, model.temperature)
    )

    @arrow_udf("lang_pred string, score double")
    def predictions(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Model(*shared.value)
        for texts in batches:
            out = [model.predict(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([p for p, _ in out], pa.string()), pa.array([s for _, s in out], pa.float64())], ["lang_pred", "score"]
            )

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    found = docs.select(*kept, predictions(F.col(column).cast("string")).alias("lang_pred"))
    return found.select(*kept, "lang_pred.lang_pred", "lang_pred.score")


def op12_language(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "lang", "text")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
