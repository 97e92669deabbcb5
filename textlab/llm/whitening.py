"""Embedding whitening by incremental eigendecomposition.

Every task keeps the spectrum (eigenvalues and eigenvectors) of the scatter of
the vectors that it has seen.  A block of vectors is centred and turned by an
orthogonal factor, which leaves its scatter and at most as many rows as there
are dimensions; each row, and the step of the mean, changes the scatter by a
rank-one term, and the new spectrum follows from the roots of the secular
equation.  Directions that a term does not touch, and directions that share an
eigenvalue, are deflated before.  Spectra of two tasks are combined by the
same step: the eigenpairs of one, and the distance of the two means, are
rank-one terms for the other.  A tree of bounded fan-in leaves one spectrum.
Its basis serves a distributed Rayleigh-Ritz step: all tasks project their
exactly centred vectors on it and sum the products, and the small projected
problem gives eigenvectors at working precision.  A last pass measures the
covariance of what was whitened.

Memory of a task is a few square matrices of the dimension; no vector is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Spectra, or sums, that one task of the tree combines.
FAN_IN = 16
#: Vectors, in dimensions, that are turned into rank-one terms at a time.
BLOCK = 16
#: Components to a vector, at most.
COMPONENTS = 8
#: Share of all variance under which a direction counts as constant.
FLAT = 1e-12
_EPS = np.finfo(np.float64).eps


def secular(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z2 / (d - x)) for rising distinct d and positive z2.

    Returns the number of the pole that each root is measured from, and its
    distance to it, so that differences to poles keep their precision.
    """
    k = len(d)
    wide = np.append(d, d[-1] + z2.sum())
    middle = (wide[:-1] + wide[1:]) / 2
    low_half = 1.0 + (z2 / (d - middle[:, None])).sum(1) > 0
    low_half[-1] = True
    origin = np.where(low_half, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    delta = d - d[origin][:, None]
    left, right = d - d[origin], wide[1:] - d[origin]
    half = (right - left) / 2
    whole = np.arange(k) == k - 1
    lo = np.where(low_half, 0.0, -half)
    hi = np.where(whole, right, np.where(low_half, half, 0.0))
    x = np.where(whole, right / 2, np.where(low_half, half / 2, -half / 2))
    below = np.tri(k, dtype=bool)
    for _ in range(60):
        gap = delta - x[:, None]
        term = z2 / gap
        slope = term / gap
        f = 1.0 + term.sum(1)
        open_ = np.abs(f) > 4 * k * _EPS * (1.0 + np.abs(term).sum(1))
        lo, hi = np.where(f < 0, x, lo), np.where(f < 0, hi, x)
        open_ &= hi - lo > 2 * _EPS * np.abs(x)
        if not open_.any():
            break
        psi = np.where(below, slope, 0.0).sum(1)
        phi = slope.sum(1) - psi
        g1, g2 = left - x, right - x
        # two poles stand for all of them, one on either side
        a, b, c = (g1 + g2) * f - g1 * g2 * (psi + phi), g1 * g2 * f, f - g1 * psi - g2 * phi
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = x + step
        out = ~((new > lo) & (new < hi))
        new[out] = (lo + hi)[out] / 2
        x = np.where(open_, new, x)
    return origin, x


def rank_one(d: np.ndarray, q: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of q diag(d) q' + rho v v' for rising d, orthogonal q and rho >= 0."""
    z = np.sqrt(rho) * (q.T @ v)
    size = max(float(np.abs(d).max(initial=0.0)), float(z @ z))
    if size == 0.0 or not (z @ z) > 0.0:
        return d, q
    tol = 8 * _EPS * size
    # directions of one eigenvalue: turned so that a single one of them holds the whole part of v
    near = np.diff(d) <= tol
    if near.any():
        q = q.copy()
        edge = np.flatnonzero(np.diff(np.concatenate([[0], near.astype(np.int8), [0]])))
        for a, b in zip(edge[::2], edge[1::2] + 1, strict=True):
            w = z[a:b].copy()
            norm = np.linalg.norm(w)
            if norm > 0.0:
                w[-1] += np.copysign(norm, w[-1])
                z[a : b - 1], z[b - 1] = 0.0, -np.copysign(norm, w[-1])
                q[:, a:b] -= np.outer(q[:, a:b] @ w, 2.0 / (w @ w) * w)
    # a part of v that moves no eigenvalue by more than rounding
    live = np.flatnonzero(np.abs(z) * np.sqrt(float(z @ z)) > tol)
    if len(live) == 0:
        return d, q
    dl, zl = d[live], z[live]
    origin, x = secular(dl, zl * zl)
    k = len(live)
    away = (dl[origin] - dl[:, None]) + x  # root j minus pole i
    under = np.where(np.tri(k, k, -1, dtype=bool), dl, np.append(dl[1:], 0.0)) - dl[:, None]
    under[:, -1] = 1.0
    fitted = np.copysign(np.sqrt(np.abs(np.prod(away / under, axis=1))), zl)  # the part of v for which the roots are exact
    u = fitted[:, None] / -away
    u /= np.sqrt((u * u).sum(0))
    d, q = d.copy(), q.copy()
    d[live], q[:, live] = dl[origin] + x, q[:, live] @ u
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


class Spectrum:
    """Count, exact sums, mean and spectrum of the scatter of the vectors seen so far."""

    def __init__(self, dim: int) -> None:
        self.n, self.sums = 0, np.zeros(dim, np.int64)
        self.mean, self.values, self.basis = np.zeros(dim), np.zeros(dim), np.eye(dim)

    def take_in(self, n: int, sums: np.ndarray, mean: np.ndarray, weights: np.ndarray, terms: np.ndarray) -> None:
        """n vectors with these sums and mean, whose scatter is the sum of weight times the square of each term (a row)."""
        for weight, term in zip(weights, terms, strict=True):
            if weight > 0.0:
                self.values, self.basis = rank_one(self.values, self.basis, term, float(weight))
        away = mean - self.mean
        if self.n:
            self.values, self.basis = rank_one(self.values, self.basis, away, self.n * n / (self.n + n))
        self.n += n
        self.mean = self.mean + away * (n / self.n)
        self.sums = self.sums + sums

    def add(self, x: np.ndarray) -> None:
        """The rows of x: centred, and turned by an orthogonal factor to at most as many rows as dimensions; their scatter stays."""
        mean = x.mean(0)
        away = x - mean
        if len(x) > x.shape[1]:
            away = np.linalg.qr(away, mode="r")
        self.take_in(len(x), x.sum(0), mean, np.ones(len(away)), away)

    def merge(self, other: Spectrum) -> None:
        self.take_in(other.n, other.sums, other.mean, other.values, other.basis.T)

    def pack(self) -> tuple[int, bytes, bytes]:
        return self.n, self.sums.tobytes(), np.concatenate([self.mean, self.values, self.basis.ravel()]).tobytes()

    @classmethod
    def unpack(cls, n: int, sums: bytes, cells: bytes) -> Spectrum:
        out = cls(0)
        out.n, out.sums, flat = n, np.frombuffer(sums, np.int64).copy(), np.frombuffer(cells)
        dim = len(out.sums)
        out.mean, out.values, out.basis = flat[:dim].copy(), flat[dim : 2 * dim].copy(), flat[2 * dim :].reshape(dim, dim).copy()
        return out


def tree(parts: DataFrame, combine: Callable[[int, list[dict]], tuple], fan_in: int) -> list[dict]:
    """One row (dim, part, n, a, b) per dim from a row per dim and task, `fan_in` at a time."""
    parts = parts.persist()
    kept = [parts]
    schema = parts.schema

    def work(key, table):
        rows = table.sort_by("part").to_pylist()
        n, a, b = combine(key[0].as_py(), rows)
        return pa.table([[key[0].as_py()], [key[1].as_py()], [n], [a], [b]], schema=pa.schema(
            [("dim", pa.int32()), ("part", pa.int32()), ("n", pa.int64()), ("a", pa.binary()), ("b", pa.binary())]))

    try:
        most = parts.agg(F.max("part")).first()[0]
        while most is not None and most > 0:
            parts = parts.withColumn("up", F.floor(F.col("part") / fan_in).cast("int")).groupBy("dim", "up").applyInArrow(work, schema).persist()
            kept.append(parts)
            most //= fan_in
        return [r.asDict() for r in parts.collect()]
    finally:
        for p in kept:
            p.unpersist()


def whole(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, rows, matrix of floor(1024 x) + 100000) for each length of the vectors in a batch."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat, first = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
    for dim in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == dim)
        x = np.floor(1024 * flat[first[rows][:, None] + np.arange(dim)]) + 100000
        if np.abs(x).max() >= 2.0**52:
            raise OverflowError("an entry does not fit the whole numbers that are whitened")
        yield int(dim), rows, x.astype(np.int64)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """n * x - sums, and the exact sum of its squares for each row."""
    if n * float(np.abs(x).max(initial=0)) + float(np.abs(sums).max(initial=0)) >= 2.0**62:
        raise OverflowError("n times an entry does not fit a long")
    away = n * x - sums
    if float(np.abs(away).max(initial=0)) ** 2 * away.shape[1] < 2.0**62:
        return away, (away * away).sum(1).tolist()
    return away, [sum(int(c) ** 2 for c in row) for row in away.tolist()]


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    fan_in: int = FAN_IN,
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): up to `components` rows per vector.

    An entry c counts as x = floor(1024 c) + 100000.  n is the number of
    vectors, deviation the exact sum over dimensions of (n x - S)^2 with the
    sums S (null where it exceeds a long), whitened the centred vector's
    projection on a unit eigenvector of the covariance over the root of its
    eigenvalue, explained the eigenvalue's share of the trace, identity_error the
    largest entry of the measured covariance of all whitened values minus the
    identity.  Components are numbered from 1 by falling eigenvalue; the largest
    entry of an eigenvector is positive; directions of equal eigenvalues come in
    any rotation.

    Null vectors and vectors with null or non-finite entries take no part.  Rows
    with a null or repeated id, and repeated rows, each count and each have their
    rows.  Vectors of different lengths are whitened apart, each length by its own
    covariance.  A direction without variance (under 1e-12 of the trace) has no
    unit variance to be scaled to and is left out, so one vector alone, equal
    vectors and empty vectors have no rows; an empty table gives none.  Other
    columns are ignored.  The vectors are read four times, never shuffled.
    """
    spark = vectors.sparkSession
    bad = F.exists(F.col("vec"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("vec").isNotNull() & ~bad)
    parts = "dim int, part int, n long, a binary, b binary"

    def spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Spectrum] = {}
        for batch in batches:
            for dim, _, x in whole(batch.column(0)):
                seen = found.setdefault(dim, Spectrum(dim))
                for a in range(0, len(x), BLOCK * dim):
                    seen.add(x[a : a + BLOCK * dim])
        yield packed({dim: s.pack() for dim, s in found.items()})

    def packed(found: dict[int, tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        part = TaskContext.get().partitionId()
        cells = [(dim, part, *row) for dim, row in found.items()]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([c[i] for c in cells], t) for i, t in enumerate(kinds)], ["dim", "part", "n", "a", "b"])

    def joint(dim: int, states: list[dict]) -> tuple[int, bytes, bytes]:
        first, *others = (Spectrum.unpack(r["n"], r["a"], r["b"]) for r in states)
        for other in others:
            first.merge(other)
        return first.pack()

    def summed(dim: int, sums: list[dict]) -> tuple[int, bytes, bytes]:
        add = lambda c: np.sum([np.frombuffer(r[c]) for r in sums], axis=0).tobytes()
        return sum(r["n"] for r in sums), add("a"), add("b")

    def moments(basis: dict[int, tuple[int, np.ndarray, np.ndarray]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """{dim: (mean, mean product)} of all vectors' projections on the given columns."""
        shared = spark.sparkContext.broadcast(basis)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, tuple] = {}
            for batch in batches:
                for dim, at, x in whole(batch.column(0)):
                    n, sums, columns = shared.value[dim]
                    y = ((n * x - sums) / n) @ columns
                    count, total, product = found.get(dim, (0, 0.0, 0.0))
                    found[dim] = count + len(at), total + y.sum(0), product + y.T @ y
            yield packed({dim: (c, t.tobytes(), p.tobytes()) for dim, (c, t, p) in found.items()})

        out = {}
        for r in tree(rows.select("vec").mapInArrow(work, parts), summed, fan_in):
            mean = np.frombuffer(r["a"]) / r["n"]
            out[r["dim"]] = mean, np.frombuffer(r["b"]).reshape(len(mean), len(mean)) / r["n"]
        return out

    states = {r["dim"]: Spectrum.unpack(r["n"], r["a"], r["b"]) for r in tree(rows.select("vec").mapInArrow(spectra, parts), joint, fan_in)}
    fitted: dict[int, tuple] = {}
    basis = {dim: (s.n, s.sums, np.linalg.qr(s.basis[:, ::-1])[0]) for dim, s in states.items()}
    for dim, (_, product) in (moments(basis) if basis else {}).items():
        n, sums, q = basis[dim]
        values, turn = np.linalg.eigh((product + product.T) / 2)
        values, vectors_ = values[::-1], (q @ turn)[:, ::-1]
        keep = np.flatnonzero(values > FLAT * max(np.trace(product), 0.0))[:components]
        e, v = values[keep], vectors_[:, keep]
        v = v * np.sign(np.take_along_axis(v, np.abs(v).argmax(0)[None], 0))
        fitted[dim] = n, sums, v / np.sqrt(e), e / np.trace(product) if len(e) else e
    error = {}
    scaled = {dim: f[:3] for dim, f in fitted.items() if f[2].shape[1]}
    for dim, (mean, product) in (moments({**basis, **scaled}) if scaled else {}).items():
        error[dim] = float(np.abs(product - np.outer(mean, mean) - np.eye(len(mean))).max())
    shared = spark.sparkContext.broadcast((fitted, error))

    def output(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, error = shared.value
        names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        for batch in batches:
            for dim, at, x in whole(batch.column(1)):
                n, sums, columns, share = fitted[dim]
                k = columns.shape[1]
                if k == 0:
                    continue
                away, squares = deviations(x, n, sums)
                squares = pa.array([s if s < 1 << 63 else None for s in squares], pa.int64())
                m = len(at)
                every = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.repeat(at, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, np.int64)),
                        squares.take(every),
                        pa.array(((away / n) @ columns).ravel()),
                        pa.array(np.tile(share, m)),
                        pa.array(np.full(m * k, error[dim])),
                    ],
                    names,
                )

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.mapInArrow(output, schema)
