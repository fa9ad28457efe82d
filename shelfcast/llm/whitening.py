"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import staged, table

COMPONENTS = 16
STEP, SHIFT = 64, 1_000_000  # of the whole numbers that entries become
LARGEST = 1 << 46  # entries beyond it count as it
BLOCK_BYTES = 4 << 20
NEGLIGIBLE = 1e-13  # relative to the largest singular value
RANK = 1e-6  # a component whose deviation is below this share of the first one's has none


def whole_numbers(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """``rows`` with a vector ``x`` of whole numbers, ``floor(64 c) + 1000000`` for each entry c as a double.

    Rows whose vector is null, empty, or holds a null or an entry that is no finite number are left out, and so are
    vectors of another length than most (of equally frequent lengths the larger counts). Entries beyond 2^40 count as that.
    """

    def usable(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    def whole(c):
        bounded = F.greatest(F.least(c * STEP, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
        return F.floor(bounded) + SHIFT

    vector = F.col(column).cast("array<double>")
    valid = rows.where((F.size(vector) > 0) & F.forall(vector, usable))
    most = valid.groupBy(F.size(column).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return valid.where(F.size(column) == (most["n"] if most else 0)).withColumn("x", F.transform(vector, whole))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _blocks(dimension: int):
    """Batches of vectors as rows of bytes, each a block of bounded size."""
    most = max(1, BLOCK_BYTES // (8 * dimension))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0))
            for at in range(0, len(x), most):
                yield pa.RecordBatch.from_arrays([pa.array([x[at : at + most].astype("<i8").tobytes()], pa.binary())], ["block"])

    return run


class Vectors:
    """The different vectors, stored in blocks, and the sums over them that are needed; only vectors of the dimension's
    length reach the driver or are sent from it."""

    def __init__(self, x: DataFrame, dimension: int) -> None:
        self.dimension = d = dimension
        self.blocks = staged(x.select("x").distinct().mapInArrow(_blocks(d), "block binary"), "vectors")

        def parts(x: np.ndarray) -> np.ndarray:
            return np.append(x.sum(axis=0), len(x))

        totals = self._added(parts, d + 1, "long")
        self.n, self.sums = totals[-1], totals[:-1]

    def _added(self, parts, size: int, kind: str = "double") -> list:
        """Sums over all blocks of the ``size`` numbers that ``parts`` makes of a block's matrix."""
        d, numbers = self.dimension, np.int64 if kind == "long" else np.float64

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, seen = np.zeros(size, numbers), False
            for batch in batches:
                for block in batch.column(0):
                    part = parts(np.frombuffer(block.as_py(), "<i8").reshape(-1, d))
                    if kind == "long":  # a block's sums are below 2^62, those of many blocks need not be
                        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(part)], ["place", "value"])
                    else:
                        total, seen = total + part, True
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["place", "value"])

        added = self.blocks.mapInArrow(run, f"place long, value {kind}").groupBy("place")
        total = F.sum(F.col("value").cast("decimal(38,0)" if kind == "long" else "double"))
        out = {r["place"]: r["value"] for r in added.agg(total.alias("value")).collect()}
        return [(int if kind == "long" else float)(out.get(i, 0)) for i in range(size)]

    def centred(self, parts, size: int) -> np.ndarray:
        """Sums over all blocks of what ``parts`` makes of their centred rows."""
        centre = centring(self.n, self.sums)
        return np.array(self._added(lambda x: parts(centre(x)), size))


def centring(n: int, sums: list[int]):
    """A function that takes the mean from rows of whole numbers: first its whole part, exactly, then the rest."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return lambda x: (x - whole).astype(np.float64) - rest


def _direction(rng: np.random.Generator, basis: list[np.ndarray], dimension: int) -> np.ndarray:
    v = rng.standard_normal(dimension)
    for _ in range(2):
        for b in basis:
            v -= (b @ v) * b
    return v / np.linalg.norm(v)


def bidiagonalise(vectors: Vectors, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The leading right singular vectors (columns) of the centred rows and their singular values, ``wanted`` at most.

    Each step multiplies the rows X with a direction and its image with their transpose, in one pass over the blocks. A
    left vector u is X z for a z of the dimension's length, so that z and Xᵀu stand for it: its products with earlier left
    vectors, which full reorthogonalisation takes off, are sums over z and Xᵀu. Steps end when the space is used up, or when
    the wanted values have settled and stay the same after a new start in a random direction, which finds repeated values.
    """
    d = vectors.dimension
    rng = np.random.default_rng(11)
    right: list[np.ndarray] = []
    z_of, g_of, alpha, beta = [], [], [], []
    v, before = _direction(rng, [], d), None
    while True:
        z = v - beta[-1] * z_of[-1] if beta and beta[-1] else v.copy()
        right.append(v)
        for _ in range(2):
            image = z

            def products(rows: np.ndarray, image: np.ndarray = image) -> np.ndarray:
                u = rows @ image
                return np.append(rows.T @ u, u @ u)

            out = vectors.centred(products, d + 1)
            g, square = out[:-1], out[-1]
            away = np.array([zk @ g for zk in z_of])
            left = square - away @ away
            for c, zk, gk in zip(away, z_of, g_of):
                z, g = z - c * zk, g - c * gk
            if left > 0.5 * square:
                break  # else most was taken off, and what is left needs products of its own
        a = float(np.sqrt(max(0.0, left)))
        scale = max([a, *alpha])
        if a <= NEGLIGIBLE * scale or a == 0:  # nothing new on the left
            a, z, g = 0.0, np.zeros(d), np.zeros(d)
            b, w = 0.0, None
        else:
            z, g = z / a, g / a
            w = g - a * v
            for _ in range(2):
                for x in right:
                    w = w - (x @ w) * x
            b = float(np.linalg.norm(w))
        alpha.append(a)
        z_of.append(z)
        g_of.append(g)
        k = len(alpha)
        if k == d:
            beta.append(0.0)
        else:
            beta.append(b if b > NEGLIGIBLE * scale else 0.0)
        left_of, values, right_of = np.linalg.svd(np.diag(alpha) + np.diag(beta[: k - 1], 1))
        first = min(wanted, k)
        settled = k >= wanted and (np.abs(beta[-1] * left_of[-1, :first]) <= NEGLIGIBLE * values[0]).all()
        if k < d and settled:
            same = before is not None and np.abs(values[:first] - before).max() <= 1e-10 * values[0]
            if not same:
                before, beta[-1] = values[:first], 0.0
        else:
            same = False
        if k == d or same:
            return np.array(right).T @ right_of[:first].T, values[:first]
        v = w / beta[-1] if beta[-1] else _direction(rng, right, d)


@dataclass
class Whitening:
    """What whitening needs, of the size dimension times components, whatever the number of rows."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # a component per column
    values: np.ndarray  # variances, falling
    explained: np.ndarray
    identity_error: float


def fit(x: DataFrame, *, components: int = COMPONENTS) -> Whitening | None:
    """Components of the covariance (divisor n) of the different vectors ``x``; None if there are none.

    A component without variance (one vector, or fewer independent ones than ``components``) is left out. The sign makes
    the largest entry of each positive.
    """
    first = x.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d = first["d"]
    vectors = Vectors(x, d)
    n = vectors.n
    basis, values = bidiagonalise(vectors, min(components, d))
    basis = basis[:, values > RANK * max(values[0], 1e-300)]
    m = basis.shape[1]
    if not m:
        return Whitening(n, vectors.sums, basis, np.zeros(0), np.zeros(0), 0.0)

    def rayleigh(rows: np.ndarray) -> np.ndarray:
        y = rows @ basis
        return np.append(y.T @ y, (rows * rows).sum())

    out = vectors.centred(rayleigh, m * m + 1)  # the same space, turned to what rounding has left
    variance, turn = np.linalg.eigh(out[:-1].reshape(m, m) / n)
    variance, basis = variance[::-1], np.linalg.qr(basis)[0] @ turn[:, ::-1]
    basis = basis * np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(m)])
    scaled = basis / np.sqrt(variance)

    def second(rows: np.ndarray) -> np.ndarray:
        y = rows @ scaled
        return (y.T @ y).ravel()

    covariance = vectors.centred(second, m * m).reshape(m, m) / n
    error = float(np.abs(covariance - np.eye(m)).max())
    return Whitening(n, vectors.sums, basis, variance, variance / (out[-1] / n), error)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the entries of (n x - S)², exact; None beyond a long."""
    most = max([abs(s) for s in sums] + [0]) + n * int(np.abs(x).max(initial=0))
    if most * most * len(sums) < 1 << 62:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(rows: DataFrame, column: str = "embedding", *, name: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Columns ``name, component, n, deviation, whitened, explained, identity_error``: a row per usable row of ``rows``
    (see ``whole_numbers``) and component.

    The components are those of the different vectors, each counted once; copies get the same values, rows without name
    too, other columns are ignored. ``deviation`` is null if it passes a long. An empty table, or one whose usable rows are all
    the same, gives no rows. Finding the different vectors is an aggregation with map-side partial sums; every step after it is a pass
    over stored blocks that adds up a few vectors; the result is a map over the input.
    """
    kept = whole_numbers(rows, column).select(F.col(name), "x")
    model = fit(kept, components=components)
    schema = T.StructType().add(name, rows.schema[name].dataType).add("component", T.IntegerType()).add("n", T.LongType()).add("deviation", T.LongType())
    for number in ("whitened", "explained", "identity_error"):
        schema.add(number, T.DoubleType())
    if model is None or not model.vectors.shape[1]:
        return rows.sparkSession.createDataFrame([], schema)
    m = model.vectors.shape[1]
    centre, scaled = centring(model.n, model.sums), model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            if not len(x):
                continue
            each = np.repeat(np.arange(len(x)), m)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)),
                 pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(each), model.n)),
                 pa.array(_deviations(x, model.n, model.sums), pa.int64()).take(pa.array(each)),
                 pa.array((centre(x) @ scaled).ravel()),
                 pa.array(np.tile(model.explained, len(x))),
                 pa.array(np.full(len(each), model.identity_error))],
                schema.names,
            )

    return kept.mapInArrow(run, schema)


def op13_whitening(spark: SparkSession, root: str) -> DataFrame:
    return whiten(table(spark, root, "embeddings"))
