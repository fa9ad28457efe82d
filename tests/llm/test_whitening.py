import math

import numpy as np
import pytest

from shelfcast.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, block int"


def plain(rows, components=16):
    """By the eigenvectors of the whole covariance matrix."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(np.float32(c)) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    exact = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], float) / n
    e, vectors = np.linalg.eigh(exact.T @ exact / n)
    e, vectors = e[::-1], vectors[:, ::-1]
    m = min(components, int((e > 1e-12 * e[0]).sum()))
    out = {}
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        white = np.array([n * a - s for a, s in zip(x, sums)], float) / n @ vectors[:, :m] / np.sqrt(e[:m])
        out.setdefault(i, []).append((n, deviation, white, e[:m] / e.sum()))
    return out, m


def compare(spark, rows, partitions=3):
    expected, m = plain(rows)
    docs = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], SCHEMA).repartition(partitions)
    found = whitening.whiten(docs)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = found.collect()
    assert len(found) == m * sum(map(len, expected.values()))
    sign = np.zeros(m)
    for r in sorted(found, key=lambda r: -abs(r.whitened)):
        n, deviation, white, share = expected[r.vec_id][0]
        k = r.component - 1
        sign[k] = sign[k] or np.sign(r.whitened * white[k])
        assert (r.n, r.deviation) == (n, deviation)
        assert r.whitened == pytest.approx(sign[k] * white[k], abs=1e-9)
        assert r.explained == pytest.approx(share[k], rel=1e-9) and r.identity_error < 1e-9
    return found


def test_against_the_whole_covariance(spark):
    rng = np.random.default_rng(4)
    data = (rng.standard_normal((300, 24)) * np.linspace(3, 0.2, 24) + 5).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(data.tolist())]
    rows += [(i, rows[7][1]) for i in range(1000, 1150)] + [(None, rows[8][1]), (3, rows[3][1])]  # copies, a third of all
    rows += [(2000, None), (2001, []), (2002, [None] * 24), (2003, [float("nan")] * 24), (2004, [float("inf")] + [0.0] * 23)]
    compare(spark, rows)


def test_fewer_dimensions_and_dependent_columns(spark):
    rng = np.random.default_rng(5)
    data = rng.integers(-40, 40, (60, 3))
    rows = [(i, [float(a), float(b), float(a + b), 2.0, float(c)]) for i, (a, b, c) in enumerate(data.tolist())]
    assert {r.component for r in compare(spark, rows)} == {1, 2, 3}


def test_equal_variances(spark):
    # a cross: every direction has the same variance, so only the space and the scale are defined
    rows = [(2 * i + s, [(1.0 if s else -1.0) * (j == i) for j in range(20)]) for i in range(20) for s in (0, 1)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = whitening.whiten(docs).collect()
    assert {r.component for r in found} == set(range(1, 17))
    assert all(r.identity_error < 1e-9 and r.explained == pytest.approx(1 / 20) for r in found)


def test_driver_table(spark, data_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data_dir}/embeddings.parquet").collect()]
    expected, m = plain(rows)
    found = whitening.op13_whitening(spark, data_dir).collect()
    assert len(found) == 16 * len(rows) and m == 16
    white = {(r.vec_id, r.component): r.whitened for r in found}
    for k in range(16):
        mine = np.array([white[i, k + 1] for i, _ in rows])
        theirs = np.array([expected[i][0][2][k] for i, _ in rows])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-8


def test_settles_before_the_space_is_used_up(spark):
    rng = np.random.default_rng(6)
    data = rng.standard_normal((400, 6)) * [9, 8, 7, 3, 2, 1] @ rng.standard_normal((6, 120)) + 0.02 * rng.standard_normal((400, 120))
    x = whitening.whole_numbers(spark.createDataFrame([(i, v) for i, v in enumerate(data.tolist())], "vec_id long, embedding array<double>"))
    vectors = whitening.Vectors(x, 120)
    passes = []
    counted = vectors.centred
    vectors.centred = lambda *a: passes.append(1) or counted(*a)
    basis, values = whitening.bidiagonalise(vectors, 3)
    assert len(passes) < 90
    rows = np.array([r.x for r in x.collect()], float)
    expected = np.linalg.svd(rows - rows.mean(axis=0), compute_uv=False)[:3]
    assert values == pytest.approx(expected, rel=1e-10)


def test_large_and_odd_vectors(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [5.0, 2.0]), (4, [1.0]), (5, [1.0, 2.0, 3.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = whitening.whiten(docs).collect()
    assert {r.vec_id for r in found} == {1, 2, 3}
    assert all(r.deviation is None for r in found if r.vec_id < 3)
    assert whitening._deviations(np.array([[3, 1]]), 2, [10**18, 5]) == [None]


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        docs = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
        out = whitening.whiten(docs)
        assert out.collect() == [] and dict(out.dtypes)["vec_id"] == "string"
