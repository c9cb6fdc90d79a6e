"""Whitened principal components of vectors, by incremental eigendecomposition.

Every task keeps the spectrum of its own vectors (count, exact sums, eigenvalues and eigenvectors of the centred scatter
matrix) and takes each vector in by a centred rank-one update: the roots of the secular equation are the new eigenvalues,
and entries that cannot change anything are deflated first. Spectra of tasks are put together the same way: each eigenpair
of the one, and the difference of the two means, are rank-one updates of the other. At the end one distributed
Rayleigh-Ritz pass over all vectors turns the basis into eigenvectors to double precision; where fewer directions than
dimensions are kept (`rank`), passes go on until the residual is within rounding.

An entry c becomes the integer x = floor(1024 * c) + 100000, so means and deviations are exact.

Defined cases: rows whose vector is null or holds null or non-finite entries, or whose vector has not the table's length
(the commonest; of equally common ones the longest), are left out; equal vectors and repeated or null ids are rows like any
other (equal vectors of a batch are one update of their number); a direction without variance cannot be whitened: its
component has explained 0 and a null `whitened`, and identity_error is of the others; a deviation beyond 64 bits is null; an
empty table, or vectors without entries, give no rows; columns but vec_id and embedding are not read.

The cost of an update grows with rank squared times the length of a vector; all directions of vectors of 64 entries take
a fraction of a millisecond. A task holds one basis, and the driver gets one.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.vectors import combined, distinct, floors, matrix, states, usable

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
EPS = np.finfo(np.float64).eps
# Of the terms of the secular equation; the eigenvectors are orthogonal for any roots, and the last pass mends the rest.
ROOTS_SETTLED = 1e-13
# Of the largest Ritz value: residuals within it are rounding.
SETTLED = 1e-12
# Of the trace: what is below is no variance but rounding.
NO_VARIANCE = 1e-12


def secular_roots(d: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum(weight / (d - root)), one above each of the rising `d`, and d[i] - root[j] at [j, i], without cancellation.

    Leading axes are of equations that are solved side by side.
    """
    shape, k = d.shape, d.shape[-1]
    d, weight = d.reshape(-1, k), weight.reshape(-1, k)
    # A row for every root of every equation; roots that are settled are left out of the next round.
    equation, own = np.repeat(np.arange(len(d)), k), np.tile(np.arange(k), len(d))
    last = own == k - 1
    above = np.concatenate([d[:, 1:], d[:, -1:] + weight.sum(-1, keepdims=True)], -1)
    width = (above - d).ravel()
    weights, lower = weight[equation], np.tri(k)[own]

    def step_from(gap: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The value at every root's present place, the step that a model with two poles proposes, and the sum of all terms' sizes."""
        term = weights[rows] / gap
        value = 1 + term.sum(-1)
        slope = term / gap
        below = np.einsum("ri,ri->r", slope, lower[rows])
        over = slope.sum(-1) - below
        at = np.arange(len(rows))
        first = gap[at, own[rows]]
        second = np.where(last[rows], first + width[rows], gap[at, np.minimum(own[rows] + 1, k - 1)])
        # Poles on either side are kept, the rest is a constant: a quadratic equation for the step.
        c = value - first * below - second * over
        a = (first + second) * value - first * second * (below + over)
        b = first * second * value
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            return value, np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root)), np.abs(term).sum(-1)

    def within(new: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return np.where((new > low) & (new < high), new, (low + high) / 2)

    half, rows = width / 2, np.arange(len(own))
    origin = d.ravel().copy()
    value, step, _ = step_from(d[equation] - (origin + half)[:, None], rows)
    low_side = value >= 0
    # Distances are taken from the nearer pole; above the last one there is none.
    near_own = low_side | last
    origin = np.where(near_own, origin, above.ravel())
    from_origin = d[equation] - origin[:, None]
    low = np.where(low_side, 0.0, np.where(near_own, half, -half))
    high = np.where(low_side, half, np.where(near_own, width, 0.0))
    step = within(np.where(near_own, half, -half) + step, low, high)
    for _ in range(50):
        value, move, sizes = step_from(from_origin[rows] - step[rows, None], rows)
        low[rows], high[rows] = np.where(value < 0, step[rows], low[rows]), np.where(value > 0, step[rows], high[rows])
        new = within(step[rows] + move, low[rows], high[rows])
        settled = np.abs(value) <= ROOTS_SETTLED * (1 + sizes)
        stuck = np.abs(new - step[rows]) <= 2 * EPS * np.abs(new)
        step[rows] = np.where(settled, step[rows], new)
        rows = rows[~settled & ~stuck]
        if not len(rows):
            break
    return (origin + step).reshape(shape), (from_origin - step[:, None]).reshape(*shape, k)


def turned(d: np.ndarray, z: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """The eigenvectors of diag(d) + weight * z z' in columns, from all d[i] - root[j].

    They are those of the update for which the computed roots are exact, and so orthogonal to working precision.
    """
    apart = d[..., :, None] - d[..., None, :]
    diagonal = np.arange(d.shape[-1])
    apart[..., diagonal, diagonal] = 1.0
    exact = np.sqrt(np.abs(np.prod(gap / apart, axis=-2))) * np.sign(z)
    turn = exact[..., None, :] / gap
    turn /= np.sqrt((turn * turn).sum(-1, keepdims=True))
    return np.swapaxes(turn, -1, -2)


def negligible(d: np.ndarray, z: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms of z, and what of weight * norm * z or of a difference of eigenvalues is within rounding."""
    norm = np.sqrt((z * z).sum(-1))
    return norm, 8 * EPS * np.maximum(d[..., -1], weight * norm * norm)


class Spectrum:
    """Count, mean, and the eigenpairs (rising) of the centred scatter matrix of the vectors taken in."""

    def __init__(self, size: int, rank: int):
        self.size, self.rank = size, rank
        self.n = 0
        self.mean = np.zeros(size)
        self.values = np.empty(0)
        self.basis = np.empty((size, 0))

    def state(self) -> tuple:
        return self.size, self.rank, self.n, self.mean, self.values, self.basis

    @classmethod
    def of(cls, state: tuple) -> Spectrum:
        own = cls(*state[:2])
        own.n, own.mean, own.values, own.basis = state[2:]
        return own

    def add(self, x: np.ndarray, times: int = 1) -> None:
        """Take in a vector, `times` over."""
        away = x - self.mean
        if self.n:
            self.update(away, self.n * times / (self.n + times))
        self.n += times
        self.mean = self.mean + away * (times / self.n)

    def merge(self, other: Spectrum) -> None:
        """Take in all that the other spectrum holds."""
        if not other.n:
            return
        for value, direction in zip(other.values, other.basis.T, strict=True):
            if value > 0:
                self.update(direction, value)
        away = other.mean - self.mean
        if self.n:
            self.update(away, self.n * other.n / (self.n + other.n))
        self.n += other.n
        self.mean = self.mean + away * (other.n / self.n)

    def update(self, vector: np.ndarray, weight: float) -> None:
        """Scatter matrix plus weight * vector vector'."""
        length = np.sqrt(vector @ vector)
        if not length:
            return
        z = vector @ self.basis
        if self.basis.shape[1] < self.size:
            rest = vector - self.basis @ z
            rest = rest - self.basis @ (rest @ self.basis)
            far = np.sqrt(rest @ rest)
            if far > 1e-12 * length:
                self.basis = np.column_stack([rest / far, self.basis])
                self.values = np.append(0.0, self.values)
                z = np.append(far, z)
        if len(z):
            self._rotate(z, weight)
        if len(self.values) > self.rank:
            self.values, self.basis = self.values[-self.rank :], self.basis[:, -self.rank :]

    def _rotate(self, z: np.ndarray, weight: float) -> None:
        d, q = self.values.copy(), self.basis.copy()
        norm, least = negligible(d, z, weight)
        active = np.flatnonzero(weight * norm * np.abs(z) > least)
        if len(active) > 1:
            a, b = active[:-1], active[1:]
            if (np.abs((d[b] - d[a]) * z[a] * z[b]) <= least * (z[a] ** 2 + z[b] ** 2)).any():
                active = self._deflated(d, z, q, active, least)
        if not len(active):
            return
        roots, gap = secular_roots(d[active], weight * z[active] ** 2)
        q[:, active] = q[:, active] @ turned(d[active], z[active], gap)
        d[active] = roots
        order = np.argsort(d, kind="stable")
        self.values, self.basis = np.maximum(d[order], 0.0), q[:, order]

    @staticmethod
    def _deflated(d, z, q, active, least):
        """Where two eigenvalues are as good as equal, turn their directions so that one of them is left out of the update."""
        kept, last = [], active[0]
        for j in active[1:]:
            r = np.hypot(z[last], z[j])
            c, s = z[j] / r, -z[last] / r
            if abs((d[j] - d[last]) * c * s) <= least:
                z[j], z[last] = r, 0.0
                q[:, [last, j]] = np.column_stack([c * q[:, last] + s * q[:, j], c * q[:, j] - s * q[:, last]])
                d[last], d[j] = d[last] * c * c + d[j] * s * s, d[last] * s * s + d[j] * c * c
            else:
                kept.append(last)
            last = j
        return np.array([*kept, last])


# Spectra that a task updates side by side.
LANES = 8


def update_all(lanes: list[Spectrum], vectors: np.ndarray, weights: np.ndarray) -> None:
    """One update of every spectrum by the vector of its own row; those with a full basis and nothing to deflate at once."""
    full = [k for k, s in enumerate(lanes) if s.basis.shape[1] == s.size]
    rest = set(range(len(lanes))) - set(full)
    if len(full) > 1:
        d, q = np.stack([lanes[k].values for k in full]), np.stack([lanes[k].basis for k in full])
        z = np.einsum("ki,kij->kj", vectors[full], q)
        w = weights[full]
        norm, least = negligible(d, z, w)
        near = np.abs((d[:, 1:] - d[:, :-1]) * z[:, 1:] * z[:, :-1]) <= least[:, None] * (z[:, 1:] ** 2 + z[:, :-1] ** 2)
        plain = (w * norm * np.abs(z).min(1) > least) & ~near.any(1)
        if plain.any():
            d, q, z, w = d[plain], q[plain], z[plain], w[plain]
            roots, gap = secular_roots(d, w[:, None] * z * z)
            q = q @ turned(d, z, gap)
            for k, values, basis in zip(np.array(full)[plain].tolist(), roots, q, strict=True):
                lanes[k].values, lanes[k].basis = values, basis
        full = np.array(full)[~plain].tolist()
    for k in [*full, *rest]:
        lanes[k].update(vectors[k], weights[k])


def add_all(lanes: list[Spectrum], x: np.ndarray, times: np.ndarray) -> None:
    """Take in vectors, dealt to the spectra in turn."""
    for at in range(0, len(x), len(lanes)):
        rows, number = x[at : at + len(lanes)], times[at : at + len(lanes)]
        own = lanes[: len(rows)]
        n = np.array([s.n for s in own], np.float64)
        away = rows - np.stack([s.mean for s in own])
        begun = np.flatnonzero(n)
        update_all([own[k] for k in begun], away[begun], (n * number / (n + number))[begun])
        for s, step, number_of in zip(own, away, number.tolist(), strict=True):
            s.n += number_of
            s.mean = s.mean + step * (number_of / s.n)


def merged(lanes: list[Spectrum]) -> Spectrum:
    """One spectrum of all, halving their number round by round."""
    while len(lanes) > 1:
        half = (len(lanes) + 1) // 2
        into, taken = lanes[: len(lanes) - half], lanes[half:]
        for k in range(max(len(s.values) for s in taken)):
            some = [(a, b) for a, b in zip(into, taken, strict=True) if k < len(b.values) and b.values[k] > 0]
            if some:
                update_all([a for a, _ in some], np.stack([b.basis[:, k] for _, b in some]), np.array([b.values[k] for _, b in some]))
        for a, b in zip(into, taken, strict=True):
            b.values, b.basis = b.values[:0], b.basis[:, :0]
            a.merge(b)
        lanes = lanes[:half]
    return lanes[0]


def integers(vectors: pa.Array, size: int) -> np.ndarray:
    return floors(matrix(vectors, size), SCALE) + SHIFT


def exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, in 64-bit integers or, beyond them, in Python's."""
    largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    return x * n - np.array(sums, np.int64) if largest < 2**63 else x.astype(object) * n - np.array(sums, object)


def exact_sums(x: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Sums of the rows, each `times` over, as Python's integers."""
    if int(np.abs(x).max(initial=0)) * int(times.sum()) < 2**63:
        return (x * times[:, None]).sum(0).astype(object)
    return (x.astype(object) * times[:, None]).sum(0)


def squares(deviation: np.ndarray) -> list[int | None]:
    """Sums of squares of the rows, exact; null where 64 bits cannot hold one."""
    largest = max(map(abs, (int(deviation.max(initial=0)), int(deviation.min(initial=0)))))
    if largest * largest * max(deviation.shape[1], 1) >= 2**63:
        deviation = deviation.astype(object)
    found = (deviation * deviation).sum(1).tolist()
    return [s if s < 2**63 else None for s in found]


class Whitening:
    """What `fit` has found: count, exact sums, components in columns by falling eigenvalue, and the trace."""

    def __init__(self, size, n, sums, values, vectors, trace):
        self.size, self.n, self.sums, self.values, self.vectors, self.trace = size, n, sums, values, vectors, trace

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (exact_deviation(x, self.n, self.sums) / self.n).astype(np.float64)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """NaN where a direction has no variance."""
        safe = np.where(self.values > NO_VARIANCE * self.trace, self.values, np.nan)
        return self.centred(x) @ self.vectors / np.sqrt(safe)


def add_up(held: bytes | None, state: bytes) -> bytes:
    if held is None:
        return state
    return pickle.dumps([a + b for a, b in zip(pickle.loads(held), pickle.loads(state), strict=True)])


def summed(vectors: DataFrame, size: int, of) -> list | None:
    """Sums over all vectors of what `of` makes of the different integer vectors of a batch and their numbers."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = of(*distinct(integers(batch.column(0), size)))
                total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
        yield states([] if total is None else [(0, pickle.dumps(total))])

    parts = vectors.select("vector").mapInArrow(sums, "part int, state binary")
    state = combined(parts.withColumn("part", F.spark_partition_id()), add_up)
    return None if state is None else pickle.loads(state)


def spectrum(vectors: DataFrame, size: int, rank: int) -> tuple[Spectrum, int, list[int]] | None:
    """The spectrum of all vectors, by rank-one updates in tasks and between tasks, their number and exact sums."""

    def take_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lanes, n, sums = [Spectrum(size, rank) for _ in range(LANES)], 0, np.zeros(size, object)
        for batch in batches:
            x, times = distinct(integers(batch.column(0), size))
            add_all(lanes, x.astype(np.float64), times)
            n += batch.num_rows
            sums = sums + exact_sums(x, times)
        yield states([(0, pickle.dumps((merged(lanes).state(), n, sums.tolist())))] if n else [])

    def merge(held: bytes | None, state: bytes) -> bytes:
        if held is None:
            return state
        own, n, sums = pickle.loads(held)
        other, more, added = pickle.loads(state)
        both = Spectrum.of(own)
        both.merge(Spectrum.of(other))
        return pickle.dumps((both.state(), n + more, [a + b for a, b in zip(sums, added, strict=True)]))

    parts = vectors.select("vector").mapInArrow(take_in, "part int, state binary")
    state = combined(parts.withColumn("part", F.spark_partition_id()), merge)
    if state is None:
        return None
    own, n, sums = pickle.loads(state)
    return Spectrum.of(own), n, sums


def fit(vectors: DataFrame, size: int, components: int = COMPONENTS, rank: int | None = None) -> Whitening | None:
    """Components of vectors as `usable` gives them; null where there are none. `rank`: directions kept, all by default."""
    rank = min(size, rank or size)
    found = spectrum(vectors, size, max(rank, min(components, size))) if size else None
    if found is None:
        return None
    own, n, sums = found
    wanted = min(components, size)
    model = Whitening(size, n, sums, np.zeros(wanted), np.zeros((size, wanted)), 0.0)
    basis = np.linalg.qr(own.basis)[0] if own.basis.shape[1] else own.basis
    while basis.shape[1]:

        def image(x: np.ndarray, times: np.ndarray, basis=basis) -> list[np.ndarray]:
            c = model.centred(x)
            weighted = c * times[:, None]
            return [weighted.T @ (c @ basis), (weighted * c).sum()]

        image_sum, trace = summed(vectors, size, image)
        covered = image_sum / n
        inner = basis.T @ covered
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, covered = basis @ turn, covered @ turn
        k = min(wanted, len(values))
        residual = np.abs(covered[:, :k] - ritz[:, :k] * values[:k]).max()
        model.trace = float(trace) / n
        if basis.shape[1] == own.size or residual <= SETTLED * values[0]:
            model.values[:k], model.vectors[:, :k] = np.maximum(values[:k], 0), ritz[:, :k]
            break
        basis = np.linalg.qr(covered)[0]
    # Either sign is right; the largest entry is made positive.
    top = np.abs(model.vectors).argmax(0)
    model.vectors *= np.where(model.vectors[top, np.arange(wanted)] < 0, -1.0, 1.0)
    return model


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of what is whitened, minus the identity; directions without variance left out."""
    varied = model.values > NO_VARIANCE * model.trace
    if not varied.any():
        return 0.0

    def moments(x: np.ndarray, times: np.ndarray) -> list[np.ndarray]:
        w = model.whitened(x)[:, varied]
        weighted = w * times[:, None]
        return [weighted.sum(0), weighted.T @ w]

    first, second = summed(vectors, model.size, moments)
    mean = first / model.n
    return float(np.abs(second / model.n - np.outer(mean, mean) - np.eye(len(mean))).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, rank: int | None = None) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: a row per usable vector and component.

    `deviation` is the exact sum of squares of n * x - S, with S the sums of all x.
    """
    rows, size = usable(vectors.select("vec_id", "embedding"))
    kind = rows.schema["vec_id"].dataType
    schema = T.StructType(
        [
            T.StructField("vec_id", kind),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    model = fit(rows, size, components, rank)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, model)
    explained = model.values / model.trace if model.trace else model.values
    k = len(explained)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            x = integers(batch.column(1), size)
            deviation = pa.array(squares(exact_deviation(x, model.n, model.sums)), pa.int64())
            row = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(row),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    deviation.take(row),
                    pa.array(model.whitened(x).ravel(), from_pandas=True),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                [f.name for f in schema],
            )

    return rows.select("vec_id", "vector").mapInArrow(project, schema)
