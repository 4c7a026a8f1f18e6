"""Whitening against dense linear algebra and exact sums."""

import math

import numpy as np
import pytest

from bourseline.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, x string, component int, whitened double"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "x", 3, 0.5) for i, v in vectors], SCHEMA)


def whitened(spark, vectors, components=16):
    rows = whitening.on_grid(table(spark, vectors), "vec_id", "embedding")
    return whitening.whiten(rows, whitening.train(rows, components), "vec_id").collect()


def check(vectors, rows, components):
    """Compare with the plain definition; the vectors are finite, of one dimension and have ids of their own."""
    grid = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in vectors}
    fit = sorted(set(map(tuple, grid.values())))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit])
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    by_key = {}
    for r in rows:
        by_key.setdefault(r["vec_id"], {})[r["component"]] = r
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    assert set(by_key) == set(grid) and all(sorted(c) == list(range(1, k + 1)) for c in by_key.values())
    plain = np.array([[(n * c - s) / n for c, s in zip(grid[i], sums)] for i in by_key]) @ directions[:, :k] / np.sqrt(values[:k])
    got = np.array([[by_key[i][c]["whitened"] for c in range(1, k + 1)] for i in by_key])
    gaps = np.abs(np.diff(values[: k + 1])) / values[0] if len(values) > k else np.append(np.abs(np.diff(values)), 1.0) / values[0]
    for c in range(k):
        if gaps[c] > 1e-6 and (c == 0 or gaps[c - 1] > 1e-6):  # a direction of its own
            assert min(np.abs(got[:, c] - plain[:, c]).max(), np.abs(got[:, c] + plain[:, c]).max()) < 1e-7
        assert np.isclose(by_key[vectors[0][0]][c + 1]["explained"], values[c] / values.sum(), rtol=1e-9)
    for i, c in by_key.items():
        deviation = sum((n * x - s) ** 2 for x, s in zip(grid[i], sums))
        assert {(r["n"], r["deviation"]) for r in c.values()} == {(n, deviation)}
        assert all(r["identity_error"] < 1e-9 for r in c.values())


@pytest.mark.parametrize("kind", ["random", "copies", "low rank", "two equal variances", "narrow"])
def test_against_eigenvectors(spark, kind):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(300, 24)) * np.linspace(1, 3, 24)
    if kind == "copies":
        m[100:] = m[0]
    elif kind == "low rank":
        m[:, 4:] = 0.25
    elif kind == "two equal variances":
        m = np.kron(np.eye(24), [[1.0], [-1.0]]) * 3
    elif kind == "narrow":
        m = m[:, :3]
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(m)]
    check(vectors, whitened(spark, vectors), 16)


def test_embeddings_of_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = [(r["vec_id"], r["embedding"]) for r in rows.collect()]
    check(vectors, whitened(spark, vectors), 16)


def test_odd_rows(spark):
    nan = float("nan")
    vectors = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0, 2.0]), (None, [2.0, 5.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [float("inf"), 1.0]), (7, []),
        (8, [1.0, 2.0, 3.0]), (9, [2.0, 2.0, 3.5]), (10, [-1.0]),
    ]
    rows = whitened(spark, vectors)
    assert sorted((r["vec_id"] or -1, r["component"], r["n"]) for r in rows) == [(-1, 1, 3), (-1, 2, 3), (1, 1, 3), (1, 1, 3), (1, 2, 3), (1, 2, 3), (2, 1, 3), (2, 2, 3), (8, 1, 2), (9, 1, 2)]
    assert all(r["identity_error"] < 1e-12 for r in rows)
    assert whitened(spark, []) == [] and whitened(spark, vectors[4:9]) == []


def test_deviations_are_exact_and_null_beyond_64_bits():
    sums = np.array([3_000_007, -5], dtype=np.int64)
    x = np.array([[1_000_001, 4], [(1 << 45), -(1 << 45)]], dtype=np.int64)
    got = whitening._exact_squares(x, 3, sums)
    assert got == [(3 * 1_000_001 - 3_000_007) ** 2 + (12 + 5) ** 2, None]


def test_triangles_are_joined_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "ROWS", 7)
    rng = np.random.default_rng(6)
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(200, 5)))]
    rows = whitening.on_grid(table(spark, vectors).repartition(9), "vec_id", "embedding")
    check(vectors, whitening.whiten(rows, whitening.train(rows, 16), "vec_id").collect(), 16)


def test_dqds_and_twisted_vectors_keep_small_values():
    """A graded bidiagonal matrix: values over 16 orders of size, against exact rational bisection by Sturm counts."""
    from fractions import Fraction

    diagonal, above = np.array([1e-3, 1.0, 1e3, 1e-8]), np.array([1e-5, 3.0, 1e-9])
    q, e = [Fraction(float(v)) ** 2 for v in diagonal], [Fraction(float(v)) ** 2 for v in above]

    def below(x):
        count, d = 0, q[0] - x  # the tridiagonal matrix B'B has q[i] + e[i-1] on its diagonal and q[i] * e[i] squared beside it
        for i in range(len(q)):
            count += d < 0
            if i + 1 < len(q):
                d = q[i + 1] + e[i] - x - q[i] * e[i] / (d if d else Fraction(1, 10**400))
        return count

    for k, value in enumerate(whitening.dqds(diagonal, above)):
        exact = Fraction(float(value))
        assert below(exact * (1 + Fraction(1, 10**13))) >= 4 - k and below(exact * (1 - Fraction(1, 10**13))) <= 3 - k
        z = whitening.twisted(diagonal, above, float(value))
        b = np.diag(diagonal) + np.diag(above, 1)
        assert np.linalg.norm(b.T @ (b @ z) - value * z) <= 1e-12 * value + 1e-21  # the residual itself is rounded


def test_singular_pairs_of_hard_matrices():
    rng = np.random.default_rng(0)
    clusters = rng.normal(size=(20, 40))[rng.integers(0, 20, 900)] + 1e-7 * rng.normal(size=(900, 40))
    wilkinson = np.diag(np.abs(np.arange(-10, 11.0)) + 1) + np.diag(np.ones(20), 1)
    for a in (clusters, wilkinson, np.eye(7), np.ones((5, 5)), np.zeros((4, 4)), np.array([[2.0]])):
        r = np.linalg.qr(a, mode="r")
        values, v = whitening.singular(r, 40)
        want = np.linalg.svd(a, compute_uv=False) ** 2
        assert np.abs(values - want[: len(values)]).max(initial=0) <= 1e-12 * want[0] and (want[len(values) :] <= 1e-20 * want[0]).all()
        assert np.abs(v.T @ v - np.eye(len(values))).max(initial=0) < 1e-10
        assert np.linalg.norm(a.T @ (a @ v) - v * values) <= 1e-12 * want[0] * 10
