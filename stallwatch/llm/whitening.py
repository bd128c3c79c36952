"""Whitening of embeddings by an incremental eigendecomposition.

Every partition of the fit list keeps a spectrum: how many vectors it has seen, their mean, and eigenvalues and
eigenvectors of their scatter about it. A vector is a centred rank-one update of it: components that hardly take
part are deflated, the others' new eigenvalues are the roots of a secular equation, and the eigenvectors follow from the
roots. Two spectra are combined in the same way, by one update for each eigenvector of the second and one for the
distance of the means; spectra meet in groups of bounded size, level by level. The basis found so is refined by a
Rayleigh-Ritz step: all partitions project their vectors, centred by the exact mean, on it, and the small matrix of
their products is solved.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwatch.llm.scratch import Scratch

#: Entries are cut to whole steps of 1 / GRID.
GRID = 256
#: Spectra, or sums, that one task combines.
FAN_IN = 32
EPS = np.finfo(float).eps


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum(weights**2 / (poles - x)): (nearest pole's number, distance from it) of each.

    poles ascend strictly, no weight is 0. Root i lies between poles i and i + 1, the last one within the sum of squares
    above the last pole. Every step fits a pole on either side to the function; one that leaves the bracket halves it.
    """
    n = len(poles)
    squares = weights**2
    ends = np.append(poles, poles[-1] + squares.sum())
    gap = np.diff(ends)
    middle = poles + gap / 2
    f = 1 + (squares / (poles - middle[:, None])).sum(1)
    near = np.arange(n) + (f < 0)  # the root is in the upper half where the function is still negative
    near[-1] = n - 1
    base = poles[near]
    low = np.where(near > np.arange(n), -gap / 2, 0.0)
    high = np.where(near > np.arange(n), 0.0, np.where(f < 0, gap, gap / 2))
    shifted = poles - base[:, None]  # differences of poles are exact where it matters
    lower = np.tri(n)  # row i marks the poles below root i
    each = np.arange(n)
    x = (low + high) / 2
    for _ in range(100):
        d = shifted - x[:, None]
        terms = squares / d
        below, total = np.einsum("ij,ij->i", terms, lower), terms.sum(1)
        value = 1 + total
        done = np.abs(value) <= 4 * n * EPS * (1 + total - 2 * below)  # the terms below are negative
        low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
        done |= high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high))
        if done.all():
            break
        own, other = d[each, each], np.append(d[each[:-1], each[1:]], gap[-1] - x[-1])
        slopes = terms / d
        slope_below, slope = np.einsum("ij,ij->i", slopes, lower), slopes.sum(1)
        c = value - own * slope_below - other * (slope - slope_below)
        a = (own + other) * value - own * other * slope
        b = own * other * value
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        x_new = x + step
        inside = np.isfinite(x_new) & (x_new > low) & (x_new < high)
        x = np.where(done, x, np.where(inside, x_new, (low + high) / 2))
    return near, x


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, ascending, and eigenvectors (columns) of vectors * values * vectors' + v * v'."""
    z = vectors.T @ v
    size = np.sqrt(z @ z)
    scale = max(abs(values[-1]), abs(values[0]), size * size)
    if not scale:
        return values, vectors
    limit = 8 * EPS * scale
    # Deflation of equal eigenvalues: their share of v is turned into a single one of them.
    new = np.diff(values) > limit
    if not new.all():
        vectors = vectors.copy()
        starts = np.flatnonzero(np.append(True, new))
        for lo, hi in zip(starts, np.append(starts[1:], len(values))):
            part = z[lo:hi]
            norm = np.sqrt(part @ part)
            if hi - lo > 1 and norm:
                h = part.copy()
                h[-1] += np.copysign(norm, part[-1])
                block = vectors[:, lo:hi]
                vectors[:, lo:hi] = block - np.outer(block @ h, 2 * h / (h @ h))
                sign = -np.copysign(norm, part[-1])
                z[lo:hi] = 0
                z[hi - 1] = sign
    # Deflation of components that hardly take part.
    own = np.flatnonzero(np.abs(z) * size > limit)
    if not len(own):
        return values, vectors
    d, w = values[own], z[own]
    near, x = secular_roots(d, w)
    away = (d[:, None] - d[near]) - x  # pole i less root j
    # Weights for which the computed roots are exact, so that the eigenvectors are orthogonal.
    n = len(d)
    between = d[:, None] - d
    between[np.arange(n), np.arange(n)] = 1
    ratio = -away[:, :-1] / np.where(np.arange(n - 1) < np.arange(n)[:, None], -between[:, :-1], -between[:, 1:]) if n > 1 else np.ones((n, 0))
    w = np.copysign(np.sqrt(np.abs(np.prod(ratio, axis=1) * away[:, -1])), w)
    q = w[:, None] / away
    q /= np.sqrt((q * q).sum(0))
    values, vectors = values.copy(), vectors.copy()
    values[own] = d[near] + x
    vectors[:, own] = vectors[:, own] @ q
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Number of vectors, their mean, and the eigendecomposition of their scatter about it."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dimension: int) -> "Spectrum":
        return cls(0, np.zeros(dimension), np.zeros(dimension), np.eye(dimension))

    def add(self, x: np.ndarray) -> None:
        off = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, off * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.mean = self.mean + off / self.n

    def merge(self, other: "Spectrum") -> None:
        if other.n:
            for value, vector in zip(other.values, other.vectors.T):
                if value > 0:
                    self.values, self.vectors = rank_one(self.values, self.vectors, np.sqrt(value) * vector)
            off, total = other.mean - self.mean, self.n + other.n
            if self.n:
                self.values, self.vectors = rank_one(self.values, self.vectors, off * np.sqrt(self.n * other.n / total))
            self.mean = self.mean + off * (other.n / total)
            self.n = total


def _matrix(column: pa.Array, dimension: int, numbers: type = np.int64) -> np.ndarray:
    """Rows of a list column, with zeros after those that are shorter than the dimension."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dimension), numbers)
    out[np.arange(dimension) < lengths[:, None]] = flat
    return out


def _state(state: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(state)], pa.binary())], names=["state"])


def _combined(states: DataFrame, fold: Callable[[Iterable], object], scratch: Scratch, name: str) -> object | None:
    """All states of a frame in one, by fold over groups of FAN_IN, level by level. Each level is a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            for number, state in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if number != group and held:
                    yield _state(fold(map(pickle.loads, held)))
                    held = []
                group = number
                held.append(state)
        if held:
            yield _state(fold(map(pickle.loads, held)))

    level = scratch.table(states.withColumn("number", F.monotonically_increasing_id()), f"{name}_0")
    count, i = level.count(), 0
    while count > 1:
        groups, i = -(-count // FAN_IN), i + 1
        spread = level.select(F.pmod(F.xxhash64("number"), F.lit(groups)).alias("group"), "state", "number")
        combined = spread.repartition(groups, "group").sortWithinPartitions("group", "number").select("group", "state").mapInArrow(run, "state binary")
        level = scratch.table(combined.withColumn("number", F.monotonically_increasing_id()), f"{name}_{i}")
        scratch.drop(f"{name}_{i - 1}")
        count = level.count()
    rows = level.select("state").collect()  # one
    return pickle.loads(rows[0][0]) if rows else None


def _merged(spectra: Iterable[Spectrum]) -> Spectrum:
    spectra = iter(spectra)
    total = next(spectra)
    for s in spectra:
        total.merge(s)
    return total


def _summed(sums: Iterable) -> object:
    sums = iter(sums)
    total = next(sums)
    for s in sums:
        total = tuple(a + b for a, b in zip(total, s))
    return total


def _spectra(dimension: int):
    """Each partition's spectrum, and the exact sum of its vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum = Spectrum.empty(dimension)
        for batch in batches:
            for x in _matrix(batch.column(0), dimension, np.float64):
                spectrum.add(x)
        if spectrum.n:
            yield _state(spectrum)

    return run


def _sums(dimension: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dimension, object)
        for batch in batches:
            n += batch.num_rows
            total += _matrix(batch.column(0), dimension).sum(0).astype(object)
        if n:
            yield _state((n, total))

    return run


def _products(mean: np.ndarray, basis: np.ndarray):
    """The products of the vectors' coordinates in a basis, summed over each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((basis.shape[1],) * 2)
        for batch in batches:
            at = (_matrix(batch.column(0), len(mean), np.float64) - mean) @ basis
            total += at.T @ at
        yield _state((total,))

    return run


@dataclass
class Whitening:
    """What is needed to whiten vectors: sizes of a few components of one dimension, whatever the input."""

    n: int
    sums: list[int]
    directions: np.ndarray  # one column per component
    values: np.ndarray
    explained: np.ndarray
    identity_error: float | None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def grid_vectors(embeddings: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is there and holds finite entries only, with ``x``: the entries in whole steps of 1 / GRID."""
    odd = lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf"))
    rows = embeddings.where(F.col(vector_col).isNotNull() & ~F.exists(vector_col, odd))
    return rows.withColumn("x", F.transform(vector_col, lambda e: F.floor(e.cast("double") * GRID)))


def fit_whitening(vectors: DataFrame, components: int = 4) -> Whitening | None:
    """Fits on each different ``x`` once; None if there is none. The dimension is that of the longest vector."""
    scratch = Scratch(vectors.sparkSession, "whitening")
    fit = scratch.table(vectors.select("x").distinct(), "fit")
    dimension = fit.agg(F.max(F.size("x"))).first()[0]
    if dimension is None:
        return None
    n, sums = _combined(fit.mapInArrow(_sums(dimension), "state binary"), _summed, scratch, "sums")
    found = Whitening(n, [int(s) for s in sums], np.zeros((dimension, 0)), np.zeros(0), np.zeros(0), None)
    if not dimension:
        return found
    spectrum = _combined(fit.mapInArrow(_spectra(dimension), "state binary"), _merged, scratch, "spectra")
    basis = np.linalg.qr(spectrum.vectors[:, ::-1])[0]
    (ritz,) = _combined(fit.mapInArrow(_products(found.mean, basis), "state binary"), _summed, scratch, "ritz")
    values, turn = np.linalg.eigh(ritz / n)
    values, directions = values[::-1][:components], (basis @ turn[:, ::-1])[:, :components]
    at = np.abs(directions).argmax(0)
    directions = directions * np.copysign(1.0, directions[at, np.arange(directions.shape[1])])
    trace = float(np.trace(ritz / n))
    # A component along which nothing varies has no scale.
    values = np.where(values > 1e-12 * trace, values, 0.0)
    found.directions, found.values = directions, values
    found.explained = values / trace if trace else np.full(len(values), np.nan)
    full = values > 0
    if full.any():
        scaled = directions[:, full] / np.sqrt(values[full])
        (products,) = _combined(fit.mapInArrow(_products(found.mean, scaled), "state binary"), _summed, scratch, "check")
        found.identity_error = float(np.abs(products / n - np.eye(full.sum())).max())
    scratch.drop("fit")
    return found


def _whitened(fit: Whitening):
    n, sums, k = fit.n, np.array(fit.sums, np.int64), len(fit.values)
    scale = np.where(fit.values > 0, np.sqrt(np.where(fit.values > 0, fit.values, 1)), np.nan)
    number = lambda x: pa.array(x, pa.float64(), from_pandas=True)  # noqa: E731  not a number: null

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            off = n * _matrix(batch.column(1), len(sums)) - sums
            at = (off / n) @ fit.directions / scale
            far = (off.astype(float) ** 2).sum(1) >= 2.0**62
            deviation = pa.array((off**2).sum(1), mask=far)
            columns = [np.arange(1, k + 1, dtype=np.int32), at, fit.explained]
            which = pa.array(np.repeat(np.arange(rows), k))
            error = pa.array([fit.identity_error] * (rows * k), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(which), pa.array(np.tile(columns[0], rows)), pa.array(np.full(rows * k, n)), deviation.take(which), number(at.reshape(-1)), number(np.tile(columns[2], rows)), error],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """One row per row of ``embeddings`` and component, up to ``components``: id_col, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds a null or an entry that is not finite are left out. Vectors that are shorter than the
    longest count as if zeros followed; an empty one is all zeros, and where all are empty there are no components and no rows. A vector
    that is repeated is fitted once and whitened as often as it stands there. Components along which nothing varies, such as all
    of a single vector's, have no whitened value (null), and no explained one either if nothing varies at all. deviation is null where it passes
    2**62. Null and repeated ids are rows like others, extra columns are ignored, an empty table gives no rows.
    """
    vectors = grid_vectors(embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")), "vector")
    fit = fit_whitening(vectors, components)
    schema = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fit is None or not len(fit.values):
        return embeddings.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    return vectors.select("id", "x").mapInArrow(_whitened(fit), schema).withColumnRenamed("id", id_col)
