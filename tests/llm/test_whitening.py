import math

import numpy as np
import pytest

from haemoloom.llm.whitening import _Centre, refined_eigenvectors, whitened_components
from rows import CLASHING

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def vectors(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    more = [*CLASHING, "x", "n", "component", "vector", "count", "length"]
    return df.withColumns({c: df["label"] for c in more}) if extra else df


def matrix_of(values, seed=0):
    turned = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    return (turned * np.asarray(values, float)) @ turned.T


SPECTRA = {
    "spread": np.geomspace(1e6, 1, 40),
    "cluster": np.r_[np.full(6, 5.0), 5 + 1e-9 * np.arange(6), np.linspace(1, 2, 28)],
    "two clusters": np.r_[np.full(20, 3.0), np.full(20, 2.0)],
    "zeros": np.r_[np.linspace(1, 9, 10), np.zeros(30)],
    "equal": np.ones(40),
    "close": np.r_[1 + 1e-6 * np.arange(20), np.linspace(2, 3, 20)],
    "large": np.linspace(1, 2, 40) * 1e30,
    "small": np.linspace(1, 2, 40) * 1e-30,
}


@pytest.mark.parametrize("name", SPECTRA)
def test_eigenvectors_have_double_precision(name):
    a = matrix_of(SPECTRA[name])
    values, x = refined_eigenvectors(a)
    size = np.abs(a).max()
    assert np.all(np.diff(values) <= 0)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13 * size
    assert np.abs(x.T @ x - np.eye(40)).max() < 1e-14
    assert np.abs(a @ x - x * values).max() < 1e-14 * size


def test_eigenvectors_are_better_than_single_precision():
    a = matrix_of(np.linspace(1, 4, 40))
    known = np.linalg.qr(np.random.default_rng(0).normal(size=(40, 40)))[0][:, ::-1]
    _, x = refined_eigenvectors(a)
    signs = np.sign((x * known).sum(axis=0))
    assert np.abs(x * signs - known).max() < 1e-12


def expected(rows, k=16):
    """Kept rows' (vec_id, deviation), whitened up to sign, and shares, by numpy's own solver."""
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v, *_ in rows
            if v is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept], np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    covariance = centred.T @ centred / n
    values, vectors = (np.flip(m, -1) for m in np.linalg.eigh(covariance))
    k = min(k, x.shape[1])
    z = (x - s / n) @ vectors[:, :k] / np.sqrt(values[:k])
    return [i for i, _ in kept], n, ((n * x - s) ** 2).sum(axis=1).tolist(), z, values[:k] / np.trace(covariance)


def check(got, rows):
    ids, n, deviations, z, explained = expected(rows)
    k = z.shape[1]
    got = got.orderBy(got["vec_id"].asc_nulls_first(), "deviation", "component").collect()
    assert len(got) == len(ids) * k
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, deviations[i]))
    white = np.array([r.whitened for r in sorted(got, key=lambda r: r.component)]).reshape(k, -1).T
    assert [r.vec_id for r in got] == [ids[i] for i in order for _ in range(k)]
    assert [r.deviation for r in got] == [deviations[i] for i in order for _ in range(k)]
    assert {r.n for r in got} == {n}
    signs = np.sign((white * z[order]).sum(axis=0))
    assert np.abs(white * signs - z[order]).max() < 1e-8
    assert np.abs(np.array([r.explained for r in got[:k]]) - explained).max() < 1e-10
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def some(n=300, d=24, seed=1):
    made = np.random.default_rng(seed)
    values = made.normal(size=(n, d)) * np.linspace(1, 4, d)
    return [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(values)]


@pytest.mark.parametrize("extra", [False, True])
def test_matches_numpy(spark, extra):
    rows = some()
    rows += [(1000 + i, rows[5][1], 0) for i in range(200)]  # copies do not weigh
    rows += [(1, rows[1][1], 0), (None, rows[2][1], None)]
    bad = [(2000, None, 1), (2001, [], 1), (2002, [NAN, *rows[0][1][1:]], 1), (2003, [*rows[0][1][1:], INF], 1), (2004, [None, *rows[0][1][1:]], 1)]
    check(whitened_components(vectors(spark, rows + bad, extra).repartition(3)), rows)


def test_few_dimensions(spark):
    rows = some(50, 3)
    check(whitened_components(vectors(spark, rows)), rows)


def test_vectors_of_another_length_are_left_out(spark):
    rows = some(40, 5)
    other = [(500 + i, [1.0, float(i)], 0) for i in range(10)]
    check(whitened_components(vectors(spark, rows + other)), rows)


def test_without_variance(spark):
    rows = [(i, [0.5, 0.25], 0) for i in range(3)]
    got = whitened_components(vectors(spark, rows)).collect()
    assert len(got) == 6
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(1, 0, None, None, None)}


def test_with_variance_in_one_direction(spark):
    got = whitened_components(vectors(spark, [(i, [i / 2, i / 2], 0) for i in range(5)])).collect()
    assert all(r.whitened is None for r in got if r.component == 2)
    assert np.allclose(sorted(abs(r.whitened) for r in got if r.component == 1), [0, 2**-0.5, 2**-0.5, 2**0.5, 2**0.5])
    assert {r.explained for r in got if r.component == 1} == {1.0}


@pytest.mark.parametrize("rows", [[], [(1, None, 0), (2, [NAN], 0)]])
def test_nothing_usable(spark, rows):
    assert whitened_components(vectors(spark, rows)).collect() == []


def test_deviations_are_exact_or_null():
    x = np.array([[1 << 51, 5], [7, 5], [9, 6]], np.int64)
    sums = [int(s) for s in x.sum(axis=0)]
    want = [sum((3 * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    assert _Centre(3, sums).deviations(x) == [w if w < 1 << 63 else None for w in want]
