"""Embedding whitening by incremental eigendecomposition.

A vector's entries c become whole numbers floor(256 c) (ends of long where they
don't fit). The model is learned from each distinct such vector once. Each task
goes through its vectors and keeps count, mean, eigenvalues and eigenvectors of
their scatter: a vector is a centred rank-one update, whose new eigenvalues are
the roots of a secular equation; what the update doesn't touch, and all but one
direction of equal eigenvalues, is deflated first. Two tasks' spectra are joined
by one rank-one update for each eigenpair of the smaller and one for the
distance of the means, in a tree. A last pass over all vectors projects them on
the joined eigenvectors and solves the small problem that results
(Rayleigh-Ritz), which takes the components to double precision.

Vectors that are null or hold null or non-finite entries take no part, and nor
do those of another length than most (ties: the longest); zero vectors do. Rows
of equal vectors count once in the model and each get a result; a null id is
kept. Directions without variance (beyond rounding) can't be whitened: they are
no components. ``deviation`` is null where it doesn't fit into a long. An empty
table gives no rows; a single distinct vector has no component.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import append_columns, stored
from tierline.llm.vectors import matrix

SCALE = 256
FAN = 16  # spectra that one task joins
EPS = float(np.finfo(np.float64).eps)
SAFE = 1 << 62


def roots(d: np.ndarray, z2: np.ndarray, rho: float, steps: int = 60) -> np.ndarray:
    """``d - root`` for each root (a row) of 1 + rho * sum(z2 / (d - root)) = 0.

    ``d`` rises strictly and no ``z2`` is 0, so one root follows each of ``d``.
    Each root is measured from the nearer of the two poles around it and
    found by steps of a rational model with these two poles, inside a bracket.
    """
    m = len(d)
    total = rho * z2.sum()
    after = np.append(d[1:], d[-1] + total)
    gap = after - d
    lower = np.tril(np.ones((m, m)))  # poles up to the root's own
    own = np.arange(m)

    middle = d[None, :] - d[:, None] - (gap / 2)[:, None]
    at_middle = 1 / rho + (z2 / middle).sum(axis=1)
    left = at_middle >= 0  # the root lies in the left half
    left[-1] = True
    origin = np.where(left, d, after)
    base = d[None, :] - origin[:, None]
    low, high = np.where(left, 0.0, -gap / 2), np.where(left, gap / 2, 0.0)
    high[-1] = gap[-1]
    x = (low + high) / 2
    pole, rest = d - origin, after - origin
    left = np.arange(m)  # roots that haven't settled
    for _ in range(steps):
        at = x[left]
        term = z2 / (base[left] - at[:, None])
        slope = term / (base[left] - at[:, None])
        f = 1 / rho + term.sum(axis=1)
        below, full = np.einsum("ij,ij->i", slope, lower[left]), slope.sum(axis=1)
        high[left], low[left] = np.where(f >= 0, at, high[left]), np.where(f < 0, at, low[left])
        a0, b0 = pole[left] - at, rest[left] - at
        c = f - a0 * below - b0 * (full - below)
        a = (a0 + b0) * f - a0 * b0 * full
        b = a0 * b0 * f
        inside = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            new = at + np.where(a <= 0, (a - inside) / (2 * c), 2 * b / (a + inside))
        new = np.where((new > low[left]) & (new < high[left]), new, (low[left] + high[left]) / 2)
        x[left] = np.where(f == 0, at, new)
        # what a root lacks then, the weights in rank_one make up for
        left = left[(np.abs(new - at) > 256 * EPS * np.abs(new)) & (f != 0)]
        if not len(left):
            break
    delta = base - x[:, None]
    # a root that rounding has put on its pole
    return np.where((delta == 0) & (own[:, None] == own[None, :]), -np.finfo(np.float64).tiny, delta)


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of ``vectors diag(values) vectors' + rho v v'``."""
    z = v @ vectors
    size = rho * float(z @ z)
    if size == 0:
        return values, vectors
    tiny = 8 * EPS * max(float(np.abs(values).max()), size)
    active = np.flatnonzero(np.abs(z) * np.sqrt(size * rho) > tiny)
    if not len(active):
        return values, vectors
    vectors = vectors.copy()
    # equal eigenvalues: turn their directions so that one takes the whole update
    starts = np.flatnonzero(np.diff(values[active], prepend=-np.inf) > tiny)
    if len(starts) < len(active):
        for group in np.split(active, starts[1:]):
            if len(group) > 1:
                part = z[group]
                length = np.sqrt(part @ part) * (-1 if part[0] > 0 else 1)
                w = part.copy()
                w[0] -= length
                vectors[:, group] -= np.outer(vectors[:, group] @ w, w * (2 / (w @ w)))
                z[group] = 0
                z[group[0]] = length
        active = active[starts]
    d, z = values[active], z[active]
    delta = roots(d, z * z, rho)  # d - root, a row for each root
    # weights for which the roots found are exact, so the new vectors are orthogonal
    between = d[None, :] - d[:, None]
    np.fill_diagonal(between, -1.0)
    weight = np.sqrt(np.abs(np.prod(delta / between, axis=0)))
    turn = (np.copysign(weight, z) / delta).T
    turn /= np.sqrt((turn * turn).sum(axis=0))
    own = np.arange(len(d))
    values = values.copy()
    values[active] = d - delta[own, own]
    vectors[:, active] = vectors[:, active] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Count, mean, and eigenpairs of the scatter (sum of centred squares) of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def of(blocks: Iterator[np.ndarray]) -> Spectrum | None:
        own: Spectrum | None = None
        for block in blocks:
            for x in block.astype(np.float64):
                if own is None:
                    own = Spectrum(1, x.copy(), np.zeros(len(x)), np.eye(len(x)))
                else:
                    own.add(x)
        return own

    def add(self, x: np.ndarray) -> None:
        away = x - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n / (self.n + 1))
        self.mean += away / (self.n + 1)
        self.n += 1
        if self.n % 4096 == 0:  # rounding adds up
            self.vectors, signs = np.linalg.qr(self.vectors)
            self.vectors *= np.where(np.diag(signs) < 0, -1, 1)

    @staticmethod
    def joined(a: Spectrum, b: Spectrum) -> Spectrum:
        a, b = (a, b) if a.n >= b.n else (b, a)
        values, vectors, n = a.values, a.vectors, a.n + b.n
        least = EPS * max(float(b.values[-1]), 0.0)
        for k in np.flatnonzero(b.values > least).tolist():
            values, vectors = rank_one(values, vectors, b.vectors[:, k], float(b.values[k]))
        away = b.mean - a.mean
        values, vectors = rank_one(values, vectors, away, a.n * (b.n / n))
        return Spectrum(n, a.mean + away * (b.n / n), values, vectors)


@dataclass
class Moments:
    """Count, mean and scatter matrix of some rows, centred before multiplying."""

    n: int
    mean: np.ndarray
    scatter: np.ndarray

    @staticmethod
    def of(rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0)
        away = rows - mean
        return Moments(len(rows), mean, away.T @ away)

    @staticmethod
    def joined(a: Moments, b: Moments) -> Moments:
        n, away = a.n + b.n, b.mean - a.mean
        return Moments(n, a.mean + away * (b.n / n), a.scatter + b.scatter + np.outer(away, away) * (a.n * (b.n / n)))


def folded(rows: DataFrame, column: str, begin: Callable[[Iterator[np.ndarray]], object], join: Callable[[object, object], object]) -> object:
    """What ``begin`` makes of the vectors of each task, joined in a tree of tasks; None without rows.

    The driver gets the one last state.
    """

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = begin(matrix(b.column(0)) for b in batches if b.num_rows)
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([pickle.dumps(own)], pa.binary())], names=["part", "state"])

    def of_parts(states: pd.DataFrame) -> pd.DataFrame:
        own = None
        for s in states.sort_values("part")["state"]:
            own = pickle.loads(s) if own is None else join(own, pickle.loads(s))
        return pd.DataFrame({"part": [states["part"].min() // FAN], "state": [pickle.dumps(own)]})

    states = stored(rows.select(column).mapInArrow(of_task, "part long, state binary"), "states")
    last = states.agg(F.max("part")).first()[0]
    while last is not None and last > 0:
        states, last = states.groupBy(F.floor(F.col("part") / FAN)).applyInPandas(of_parts, "part long, state binary"), last // FAN
    found = states.first()
    return None if found is None else pickle.loads(found.state)


def column_sums(blocks: Iterator[np.ndarray]) -> tuple[int, list[int]] | None:
    """Rows and exact sums of the columns."""
    n, total = 0, None
    for x in blocks:
        fits = int(np.abs(x.astype(np.float64)).max(initial=0)) * len(x) < SAFE
        own = (x if fits else x.astype(object)).sum(axis=0).tolist()
        n, total = n + len(x), own if total is None else [a + b for a, b in zip(total, own, strict=True)]
    return None if total is None else (n, total)


def whole(vector) -> F.Column:
    """floor(256 c) of each entry of a column of vectors, null where a vector takes no part."""
    x = F.col(vector).cast("array<double>")
    fine = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.when(fine, F.transform(x, lambda c: F.floor(c * SCALE).cast("long")))


@dataclass
class Whitening:
    """A fitted model: ``components`` (columns, by falling ``variances``) of the ``n`` distinct vectors with these ``sums``."""

    n: int
    sums: list[int]
    variances: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float | None

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n x - sums, exact: whole numbers, Python's own where 64 bits don't do."""
        largest = max(int(np.abs(x.astype(np.float64)).max(initial=0)) * self.n, *map(abs, self.sums))
        return x * self.n - np.array(self.sums, np.int64) if largest < SAFE // 2 else x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.scaled(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of squares of n x - sums, exact; None where it doesn't fit into a long."""
        away = self.scaled(x)
        largest = max(map(abs, (int(away.max(initial=0)), int(away.min(initial=0)))))
        if largest * largest * max(1, x.shape[1]) < SAFE:
            return (away * away).sum(axis=1).tolist()
        exact = (away.astype(object) ** 2).sum(axis=1).tolist()
        return [s if s < 1 << 63 else None for s in exact]

    def whitened(self, x: np.ndarray, upto: int) -> np.ndarray:
        return self.centred(x) @ self.components[:, :upto] / np.sqrt(self.variances[:upto])


def fit(df: DataFrame, vector: str = "embedding", check: int = 4) -> Whitening | None:
    """The model of a column of vectors; None without any that takes part.

    ``identity_error`` is the largest entry of the covariance of the first
    ``check`` whitened components minus the identity, over the fit list.
    """
    x = df.select(whole(vector).alias("x")).where("x IS NOT NULL")
    lengths = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths or lengths[0].d == 0:
        return None
    distinct = stored(x.where(F.size("x") == lengths[0].d).distinct(), "distinct")
    n, sums = folded(distinct, "x", column_sums, lambda a, b: (a[0] + b[0], [p + q for p, q in zip(a[1], b[1], strict=True)]))
    spectrum = folded(distinct, "x", Spectrum.of, Spectrum.joined)
    basis = np.linalg.qr(spectrum.vectors[:, ::-1])[0]
    model = Whitening(n, sums, np.ones(len(sums)), basis, 1.0, None)

    def moments(blocks: Iterator[np.ndarray], size: int = 4096) -> Moments | None:
        own = None
        for x in blocks:
            for i in range(0, len(x), size):
                part = Moments.of(model.whitened(x[i : i + size], len(sums)))
                own = part if own is None else Moments.joined(own, part)
        return own

    small = folded(distinct, "x", moments, Moments.joined).scatter / n
    values, turn = np.linalg.eigh((small + small.T) / 2)
    trace = float(np.trace(small))
    keep = np.flatnonzero(values > 64 * EPS * len(sums) * max(trace, 0.0))[::-1]
    components = basis @ turn[:, keep]
    lead = np.abs(components).argmax(axis=0)
    components *= np.where(components[lead, np.arange(len(keep))] < 0, -1, 1)
    model = Whitening(n, sums, values[keep], components, trace, None)
    upto = min(check, len(keep))
    if upto:
        model.variances, model.components, everything = values[keep][:upto], components[:, :upto], (values[keep], components)
        checked = folded(distinct, "x", lambda blocks: _joined(Moments.of(model.whitened(x, upto)) for x in blocks), Moments.joined)
        model.variances, model.components = everything
        model.identity_error = float(np.abs(checked.scatter / n - np.eye(upto)).max())
    return model


def _joined(parts: Iterator[Moments]) -> Moments | None:
    own = None
    for p in parts:
        own = p if own is None else Moments.joined(own, p)
    return own


def transform(df: DataFrame, model: Whitening, vector: str = "embedding", upto: int | None = None) -> DataFrame:
    """``df`` with ``deviation`` and ``whitened`` (array of double): null where the vector takes no part."""
    d = len(model.sums)
    upto = len(model.variances) if upto is None else min(upto, len(model.variances))
    mark = "_whole"
    while mark in df.columns:
        mark = "_" + mark

    def compute(column: pa.Array) -> list[pa.Array]:
        part = column.is_valid().to_numpy(zero_copy_only=False)
        x = matrix(column.filter(pa.array(part))) if part.any() else np.zeros((0, d), np.int64)
        deviation = np.full(len(column), None, object)
        deviation[part] = model.deviations(x)
        ends = np.concatenate([[0], np.cumsum(part * upto)]).astype(np.int32)
        white = pa.ListArray.from_arrays(pa.array(ends), pa.array(model.whitened(x, upto).ravel()), mask=pa.array(~part))
        return [pa.array(deviation, pa.int64()), white]

    x = df.withColumn(mark, F.when(F.size(whole(vector)) == d, whole(vector)))
    outputs = T.StructType([T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return append_columns(x, mark, outputs, compute).drop(mark)


def report(df: DataFrame, key: str = "vec_id", vector: str = "embedding", upto: int = 4) -> DataFrame:
    """Per row that takes part and component up to ``upto``: its whitened value, with the model's figures."""
    model = fit(df, vector, upto)
    if model is None:
        kinds = "n long, deviation long, whitened double, explained double, identity_error double"
        return df.select(F.col(key).cast("long").alias("vec_id"), F.lit(0).alias("component"), *[F.lit(None).cast(k.split(" ")[1]).alias(k.split(" ")[0]) for k in kinds.split(", ")]).where(F.lit(False))
    rows = transform(df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("_vector")), model, "_vector", upto)
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.variances[:upto]]).cast("array<double>")
    return rows.where("whitened IS NOT NULL").select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("_at")).alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
