import math
import random

import numpy as np
import pytest
from helpers import as_tables

from barloom.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def symmetric(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    a = (q * np.array(values, float)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        [3.0], [3.0, 2.0, 1.0], range(64, 0, -1), [10.0] * 5 + [1.0] + [0.5] * 60, [5, 4, 3, 2, 2 - 1e-9, *np.linspace(1.9, 0, 150)],
        10.0 ** -np.arange(40), [1.0] + [0.0] * 40, [0.0] * 5, [7.0] * 30,
    ],
)
def test_eigenvectors_to_double_precision(values):
    values = list(values)
    a = symmetric(values)
    found, vectors = whitening.jacobi_davidson(lambda u: a @ u, len(values), 4)
    largest = max(values) or 1.0
    assert np.abs(found - np.linalg.eigvalsh(a)[::-1][:4]).max() < 1e-13 * largest
    assert np.linalg.norm(a @ vectors - vectors * found, axis=0).max() < 1e-13 * largest
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-14


def test_minres_solves():
    a = symmetric([9, 7, 5, -3, -1, 2], 3)
    right = np.random.default_rng(1).standard_normal((6, 3))
    assert np.abs(a @ whitening.minres(lambda u: a @ u, right, 20, np.full(3, 1e-13)) - right).max() < 1e-11


def brute(rows, dims, k=4):
    good = [(i, v) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    xs = [[math.floor(256 * c) for c in v] + [0] * (dims - len(v)) for _, v in good]
    fit = sorted(set(map(tuple, xs)))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    off = np.array([[x - s / n for x, s in zip(v, sums, strict=True)] for v in fit])
    cov = off.T @ off / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = {}
    for place, ((i, _), x) in enumerate(zip(good, xs, strict=True)):
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        centred = np.array([c - s / n for c, s in zip(x, sums, strict=True)])
        for j in range(len(values)):
            out[place, j + 1] = (i, n, deviation, centred @ vectors[:, j] / math.sqrt(values[j]), values[j] / np.trace(cov))
    return out


def check(spark, monkeypatch, rows, dims, k=4):
    frame = spark.createDataFrame(rows, SCHEMA)
    as_tables(monkeypatch, queries, embeddings=frame)
    got = queries.op13_whitening(spark, "").collect()
    expected = brute(rows, dims, k)
    assert len(got) == len(expected)
    key = lambda i, c, n, d, w, e: (str(i), c, n, d, round(abs(w), 7), round(e, 9))
    mine = sorted(key(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in got)
    theirs = sorted(key(i, c, n, d, w, e) for (_, c), (i, n, d, w, e) in expected.items())
    for a, b in zip(mine, theirs, strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], abs=1e-6) and a[5] == pytest.approx(b[5], rel=1e-6)
    assert all(r.identity_error < 1e-6 for r in got)
    return got


@pytest.mark.parametrize("dims", [4, 5, 24])
def test_query_equals_brute_force(spark, monkeypatch, dims):
    rng = random.Random(dims)
    rows = [(i, [rng.gauss(0, 1 / (1 + d)) for d in range(dims)], 0) for i in range(300)]
    rows += [(1000 + i, rows[20][1], 1) for i in range(60)] + [rows[5], (None, rows[6][1], 0)]
    check(spark, monkeypatch, rows, dims)


def test_signs_are_the_same_for_all_rows(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 3 - d) for d in range(3)], 0) for i in range(50)]
    got = check(spark, monkeypatch, rows, 3, 3)
    w = np.array([[r.whitened for r in sorted(got, key=lambda r: r.vec_id) if r.component == c] for c in (1, 2, 3)])
    assert np.abs(w @ w.T / 50 - np.eye(3)).max() < 1e-9


def test_odd_vectors(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0, 0.5], 0), (1, None, 0), (2, [1.0, None, 0.0], 0), (3, [nan, 1.0, 0.0], 0), (4, [inf, 1.0, 1.0], 0), (None, [1.0, 1.0, 4.0], 0),
        (5, [1.0], 0), (6, [], 0), (7, [-0.0, 0.001, -0.001], 0), (7, [3.0, 1.0, 1.0], 0), (8, [3.0, 1.0, 1.0], 0), (9, [-2.0, 5.0, 1.0], 0),
    ]
    check(spark, monkeypatch, rows, 3, 3)


def test_far_from_zero_and_large(spark, monkeypatch):
    """A mean far above the spread costs no digits, and deviations beyond a double's whole numbers stay exact."""
    rng = random.Random(3)
    check(spark, monkeypatch, [(i, [2.0**20 + rng.randrange(4), rng.random() * 8, 5.0, rng.random()], 0) for i in range(200)], 4, 3)
    rows = [(i, [float(rng.randrange(2**17)), float(rng.randrange(2**17))], 0) for i in range(40)]
    got = check(spark, monkeypatch, rows, 2, 2)
    assert max(r.deviation for r in got) > 2**53


def test_beyond_a_long(spark, monkeypatch):
    rows = [(i, [x, 1.0], 0) for i, x in enumerate([1e30, -1e30, 5.0, 1e9])]
    as_tables(monkeypatch, queries, embeddings=spark.createDataFrame(rows, SCHEMA))
    got = queries.op13_whitening(spark, "").collect()
    assert [r.component for r in got] == [1] * 4
    assert [r.deviation is None for r in sorted(got, key=lambda r: r.vec_id)] == [True, True, False, True] or all(r.deviation is None for r in got)


def test_nothing_to_whiten(spark, monkeypatch):
    for rows in ([], [(1, [1.0, 2.0], 0)], [(1, [1.0], 0), (2, [1.0], 0)], [(1, [], 0)], [(1, None, 0)]):
        as_tables(monkeypatch, queries, embeddings=spark.createDataFrame(rows, SCHEMA))
        frame = queries.op13_whitening(spark, "")
        assert frame.collect() == [] and frame.columns[0] == "vec_id"


def test_fewer_directions_than_components(spark, monkeypatch):
    rows = [(i, [float(i), 2.0 * i, 1.0, -float(i)], 0) for i in range(9)]
    as_tables(monkeypatch, queries, embeddings=spark.createDataFrame(rows, SCHEMA))
    got = queries.op13_whitening(spark, "").collect()
    assert len(got) == 9 and {r.component for r in got} == {1} and got[0].explained == pytest.approx(1)
