"""Rank-one updates against a direct decomposition, and whitened rows against numpy."""

import math

import numpy as np
import pytest

from stallwatch.llm import whitening
from stallwatch.llm.whitening import Spectrum, rank_one, secular_roots, whiten

rng = np.random.default_rng(5)
SAMPLES = {
    "wide": np.floor(rng.normal(size=(300, 24)) * 256),
    "few values": rng.integers(0, 2, size=(120, 8)).astype(float),
    "fewer vectors than dimensions": np.floor(rng.normal(size=(5, 12)) * 50),
    "repeated": np.repeat(np.floor(rng.normal(size=(6, 4)) * 9), 20, axis=0),
    "one line": np.outer(np.arange(40.0), [3, -2, 0, 5]),
    "constant": np.full((9, 3), 7.0),
    "many scales": np.round(rng.normal(size=(200, 16)) * np.logspace(0, 6, 16)),
    "one dimension": np.floor(rng.normal(size=(30, 1)) * 99),
}


def scatter(x):
    c = x - x.mean(0)
    return c.T @ c


def spectrum_of(x):
    s = Spectrum.empty(x.shape[1])
    for v in x:
        s.add(v)
    return s


def check(s, want):
    d = len(want)
    scale = max(np.abs(want).max(), 1)
    assert np.abs(s.vectors * s.values @ s.vectors.T - want).max() <= 1e-11 * scale
    assert np.abs(s.vectors.T @ s.vectors - np.eye(d)).max() < 1e-10
    assert (np.diff(s.values) >= 0).all()


@pytest.mark.parametrize("name", SAMPLES)
def test_updates(name):
    check(spectrum_of(SAMPLES[name]), scatter(SAMPLES[name]))


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("cut", [0, 1, 0.4])
def test_combined_spectra(name, cut):
    x = SAMPLES[name]
    k = int(cut * len(x)) if cut < 1 else cut
    s = spectrum_of(x[:k])
    s.merge(spectrum_of(x[k:]))
    assert s.n == len(x) and np.allclose(s.mean, x.mean(0))
    check(s, scatter(x))


def test_secular_equation():
    for n in (1, 2, 7, 40):
        for spread in (1.0, 1e-6):
            poles = np.cumsum(rng.uniform(0.1, 1, n)) * spread
            weights = rng.normal(size=n) * rng.choice([1e-3, 1, 30], n)
            near, x = secular_roots(poles, weights)
            want = np.linalg.eigvalsh(np.diag(poles) + np.outer(weights, weights))
            assert np.allclose(poles[near] + x, want, rtol=1e-12, atol=1e-12 * want.max())


def test_deflation_leaves_what_takes_no_part():
    values, vectors = np.array([1.0, 2.0, 2.0, 5.0]), np.eye(4)
    got, basis = rank_one(values, vectors, np.array([0.0, 3.0, 4.0, 0.0]))
    assert np.allclose(got, [1, 2, 5, 27]) and np.allclose(basis @ np.diag(got) @ basis.T, np.diag(values) + np.outer([0, 3, 4, 0], [0, 3, 4, 0]))


#: Nulls, entries that are not finite, repeated vectors and ids, a null id, a shorter and an empty vector, -0.
ROWS = [(1, [0.5, 1.0, -0.25]), (2, None), (3, [0.5, None, 1.0]), (4, [float("nan"), 0.0, 0.0]), (5, [0.0, float("inf"), 0.0]), (6, [0.5, 1.0, -0.25]), (6, [-0.0, 0.001, 2.0]), (None, [1.5, -1.0, 0.125]), (7, [3.0]), (8, []), (9, [-0.001, 0.0, 0.0])]
SCHEMA = "vec_id long, embedding array<float>, component int, x string"


def expected(rows, components=4):
    kept = [(i, v) for i, v in rows if v is not None and all(e is not None and math.isfinite(e) for e in v)]
    d = max(len(v) for _, v in kept)
    x = np.array([[math.floor(256 * float(np.float32(e))) for e in v] + [0] * (d - len(v)) for _, v in kept], np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    values, vectors = np.linalg.eigh((fit - s / n).T @ (fit - s / n) / n)
    out = []
    for (i, _), row in zip(kept, x):
        for k in range(min(components, d)):
            out.append((i, k + 1, n, int(((n * row - s) ** 2).sum()), abs((row - s / n) @ vectors[:, -1 - k]) / math.sqrt(values[-1 - k]), values[-1 - k] / values.sum()))
    return out


def same(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[4])
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got), key=order)
    want = sorted(want, key=order)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-9, atol=1e-9)


def test_odd_rows(spark, monkeypatch):
    frame = spark.createDataFrame([(i, v, 9, "z") for i, v in ROWS], SCHEMA).repartition(5)
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    got = whiten(frame).collect()
    same(got, expected(ROWS))
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_given_rows(spark, sf):
    frame = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = whiten(frame.repartition(7)).collect()
    same(got, expected([(r.vec_id, r.embedding) for r in frame.collect()]))
    assert got[0].identity_error < 1e-9
    signs = {}
    for r in got:  # either sign, but one for all rows
        signs.setdefault(r.component, []).append(r.whitened)
    assert all(min(s) < 0 < max(s) for s in signs.values())


def test_nothing_varies(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    got = whiten(frame).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got) == [(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]


def test_a_line_has_one_component_with_a_scale(spark):
    frame = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(10)], "vec_id long, embedding array<double>")
    got = whiten(frame).collect()
    assert {(r.component, r.whitened is None) for r in got} == {(1, False), (2, True)} and {r.explained for r in got if r.component == 2} == {0.0}


def test_empty(spark):
    frame = spark.createDataFrame([], SCHEMA)
    out = whiten(frame)
    assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whiten(spark.createDataFrame([(1, None, 1, ""), (2, [], 1, "")], SCHEMA)).count() == 0
