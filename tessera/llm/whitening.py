"""Whitening of embeddings: the directions of largest variance, each scaled to variance 1.

An entry c becomes the whole number floor(1024 c) + 100000, so that counts and sums are exact in any order of rows.  The rows, centred by the exact means, are reduced by QR: each task
to a triangle of the width of the vectors, triangles by levels of ``FAN`` to one (no task and not the driver sees more than that many).  The last triangle R (R'R = n V, with
V the covariance) is made bidiagonal by Householder reflections; dqds, with Newton's lower bound as its shift, finds the squares of the singular values, all to high relative
accuracy, since V is never formed; a twisted factorisation for each gives its vector, and inverse iteration against the vectors before it where values are equal or nearly so.
What the driver works on is as large as R, which depends on the vectors' width alone.

Vectors that are null, empty, or hold null or non-finite entries take no part, nor those of another length than the most frequent one (of equally frequent ones the shorter), with which they
have no covariance, nor entries beyond 2^40.  Rows with null or repeated ids are rows like others.  Components without variance (rank below their number) are left out: where all
vectors are equal, and in an empty table, there are no rows.  A deviation that a long can't hold is null.  Columns other than the id and the vector are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.shared import saved, tidy

COMPONENTS = 8
#: Triangles that are merged at once, and rows that join one at once.
FAN, BLOCK_ROWS = 32, 4096
EPS = float(np.finfo(float).eps)
#: Singular values under this share of the largest are none; values nearer than this share of each other are clustered.
LEAST, CLUSTERED = 1e-11, 1e-6


@dataclass
class Whitening:
    n: int
    sums: list[int]
    eigenvalues: np.ndarray  # of the covariance, the kept components
    vectors: np.ndarray  # their unit eigenvectors, as columns
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - np.array([s / self.n for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.eigenvalues)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S)^2, exactly."""
        most = max((abs(self.n * int(v) - s) for col, s in zip(x.T, self.sums, strict=True) for v in (col.min(), col.max())), default=0) if len(x) else 0
        if self.n * (int(np.abs(x).max(initial=0)) + 1) < 2**62 and x.shape[1] * most * most < 2**63:
            d = self.n * x - np.array(self.sums, dtype=np.int64)
            return (d * d).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [v if v < 2**63 else None for v in exact]


# ---- the solver: all of the width of the vectors ------------------------------------------------

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor W of U'RW, by Householder reflections."""
    m = np.array(r, dtype=float)
    d = len(m)
    w = np.eye(d)

    def reflection(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if not size or not np.any(x[1:]):
            return None
        v = x.copy()
        v[0] += math.copysign(size, x[0])
        return v / np.linalg.norm(v)

    for k in range(d - 1):
        if (v := reflection(m[k:, k])) is not None:
            m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
        if k < d - 2 and (v := reflection(m[k, k + 1 :])) is not None:
            m[k:, k + 1 :] -= 2 * np.outer(m[k:, k + 1 :] @ v, v)
            w[:, k + 1 :] -= 2 * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), w


def newton_bound(q: list[float], e: list[float]) -> float:
    """One over the trace of the inverse: never above the smallest eigenvalue.  What the elimination from the bottom leaves in a row is one over the inverse's entry there."""
    pivot = q[-1]
    total = 1.0 / pivot if pivot else math.inf
    for i in range(len(q) - 2, -1, -1):
        below = pivot + e[i]
        pivot = q[i] * (pivot / below) if below else 0.0
        total += 1.0 / pivot if pivot else math.inf
    return 1.0 / total


def dqds(diagonal: np.ndarray, above: np.ndarray) -> list[float]:
    """The squares of a bidiagonal matrix's singular values, largest first, by differential quotient-difference steps with shifts."""
    scale = max(float(np.max(np.abs(diagonal), initial=0)), float(np.max(np.abs(above), initial=0)))
    if not scale:
        return [0.0] * len(diagonal)
    small = (100 * EPS) ** 2
    found: list[float] = []
    work = [([(float(x) / scale) ** 2 for x in diagonal], [(float(x) / scale) ** 2 for x in above], 0.0)]
    while work:
        q, e, base = work.pop()
        while q:
            n = len(q)
            if n == 1 or e[-1] <= small * (base + q[-1]) or (not q[-1] and not e[-1]):
                found.append(base + q.pop())
                if e:
                    e.pop()
                continue
            at = next((i for i in range(n - 2, -1, -1) if e[i] <= small * (base + min(q[i], q[i + 1])) or not e[i]), None)
            if at is not None:
                work.append((q[: at + 1], e[:at], base))
                q, e = q[at + 1 :], e[at + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            shift = newton_bound(q, e) * (1 - 1e-9)
            while True:
                new_q, new_e, d, ok = [], [], q[0] - shift, True
                for i in range(n - 1):
                    if d < 0:
                        ok = False
                        break
                    p = d + e[i]
                    t = q[i + 1] / p if p else 0.0
                    new_q.append(p)
                    new_e.append(e[i] * t)
                    d = d * t - shift
                if ok and d >= 0:
                    break
                shift = shift / 2 if shift > EPS * EPS else 0.0  # rounding put it above the smallest value; without a shift d can't be negative
            new_q.append(d)
            q, e, base = new_q, new_e, base + shift
    return [x * scale * scale for x in sorted(found, reverse=True)]


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit eigenvector of B'B for an eigenvalue: factorised from the top and from the bottom, joined where the pivot is smallest."""
    n = len(a)
    tiny = EPS * EPS * max(value, float(np.finfo(float).tiny) ** 0.5)
    z = np.zeros(n)
    for _ in range(3):
        s, p, lower, upper = np.zeros(n), np.zeros(n), np.zeros(n - 1), np.zeros(n - 1)
        s[0] = -value
        for i in range(n - 1):
            pivot = s[i] + a[i] * a[i]
            pivot = pivot if abs(pivot) > tiny else tiny
            lower[i] = a[i] * b[i] / pivot
            s[i + 1] = b[i] * b[i] * s[i] / pivot - value
        p[-1] = a[-1] * a[-1] - value
        for i in range(n - 2, -1, -1):
            pivot = b[i] * b[i] + p[i + 1]
            pivot = pivot if abs(pivot) > tiny else tiny
            upper[i] = a[i] * b[i] / pivot
            p[i] = p[i + 1] * (a[i] * a[i]) / pivot - value
        twist = s + p + value
        k = int(np.argmin(np.abs(twist)))
        z = np.zeros(n)
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -lower[i] * z[i + 1]
        for i in range(k, n - 1):
            z[i + 1] = -upper[i] * z[i]
        size = float(z @ z)
        z /= math.sqrt(size)
        step = float(twist[k]) / size  # the Rayleigh quotient's correction
        if abs(step) <= 4 * EPS * abs(value):
            break
        value += step
    return z


def leading(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of R'R (those that aren't nothing) and their unit eigenvectors as columns."""
    a, b, w = bidiagonal(r)
    values = dqds(a, b)
    kept = [v for v in values[:most] if v > LEAST * LEAST * values[0]]
    near = [any(abs(v - o) <= CLUSTERED * v for j, o in enumerate(values) if j != i) for i, v in enumerate(kept)]
    columns: list[np.ndarray] = []
    square = np.diag(a * a) + np.diag(np.append(0.0, b * b)[: len(a)]) + np.diag((a[:-1] * b), 1) + np.diag((a[:-1] * b), -1) if any(near) else None
    rng = np.random.default_rng(0)
    for i, v in enumerate(kept):
        if not near[i]:
            columns.append(twisted(a, b, v))
            continue
        # equal or nearly equal values share a space: any orthonormal vectors of it, each against those before
        before = [columns[j] for j in range(i) if abs(kept[j] - v) <= 1e3 * CLUSTERED * v]
        z = rng.standard_normal(len(a))
        for _ in range(4):
            z = np.linalg.solve(square - v * (1 + 8 * EPS) * np.eye(len(a)) + np.eye(len(a)) * EPS * values[0], z)
            for other in before * 2:
                z -= (other @ z) * other
            z /= np.linalg.norm(z)
        columns.append(z)
    return np.array(kept), w @ np.array(columns).T if columns else np.zeros((len(a), 0))


# ---- the passes over the table ------------------------------------------------------------------

def usable(df: DataFrame, vector: str) -> DataFrame:
    entries = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float(2**40)), F.lit(False)))
    return df.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & entries)


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of the vectors of a batch: which they are, and their whole numbers."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for size in np.unique(lengths).tolist():
        of = np.flatnonzero(lengths == size)
        c = column.take(pa.array(of)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(of), size)
        yield of, np.floor(1024 * c).astype(np.int64) + 100000


def totals(vectors: DataFrame) -> tuple[int, list[int]]:
    """How many vectors have the most frequent length, and their sums by dimension."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of, x in matrices(batch.column(0)):
                yield pa.RecordBatch.from_pydict({"size": pa.array([x.shape[1]], pa.int64()), "n": pa.array([len(of)], pa.int64()), "s": pa.array([x.sum(axis=0).tolist()], pa.list_(pa.int64()))})

    parts = saved(vectors.mapInArrow(tidy(task), "size long, n long, s array<long>"), "sums")
    most = parts.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "size").first()
    if most is None:
        return 0, []
    sums = parts.where(F.col("size") == most["size"]).select(F.posexplode("s").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).orderBy("at").collect()  # one row for each dimension
    return most["n"], [r["x"] for r in sums]


def triangle(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows' QR factorisation."""
    d, means = len(sums), np.array([s / n for s in sums])

    def joined(r: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
        return np.linalg.qr(rows if r is None else np.vstack([r, rows]), mode="r")

    def row(part: int, r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "r": pa.array([r.ravel().tolist()], pa.list_(pa.float64()))})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = None
        for batch in batches:
            for _, x in matrices(batch.column(0)):
                if x.shape[1] == d:
                    for lo in range(0, len(x), BLOCK_ROWS):
                        r = joined(r, x[lo : lo + BLOCK_ROWS] - means)
        if r is not None:
            yield row(TaskContext.get().partitionId(), r)

    def merge(table: pa.Table) -> pa.Table:
        r = None
        for x in table.column("r").to_pylist():
            r = joined(r, np.array(x).reshape(-1, d))
        return pa.Table.from_batches([row(table.column("part")[0].as_py() // FAN, r)])

    schema = "part long, r array<double>"
    level = saved(vectors.mapInArrow(tidy(task), schema), "triangles")
    while level.count() > 1:
        level = saved(level.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(merge, schema), "triangles")
    r = np.array(level.first()["r"]).reshape(-1, d)
    return np.vstack([r, np.zeros((max(0, d - len(r)), d))])[:d]


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors; None where there are none."""
    vectors = usable(df, vector).select(vector)
    n, sums = totals(vectors)
    if not n:
        return None
    r = triangle(vectors, n, sums)
    values, directions = leading(r, components)
    return Whitening(n, sums, values / n, directions, float((r * r).sum()) / n)


def mapped(df: DataFrame, model: Whitening, ids: str, vector: str, rows: Callable[[pa.Array, np.ndarray], pa.RecordBatch], schema: T.StructType | str) -> DataFrame:
    """rows(ids, x) over the batches of usable vectors of the model's length."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of, x in matrices(batch.column(1)):
                if x.shape[1] == len(model.sums):
                    yield rows(batch.column(0).take(pa.array(of)), x)

    return usable(df, vector).select(ids, vector).mapInArrow(tidy(task), schema)


def identity_error(df: DataFrame, model: Whitening, ids: str = "vec_id", vector: str = "embedding") -> float:
    """The largest entry, without its sign, of the whitened rows' covariance less the identity; batches are centred on their own and then combined."""
    k = len(model.eigenvalues)

    def rows(_: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        w = model.whitened(x)
        mean = w.mean(axis=0)
        flat = np.concatenate([w.sum(axis=0), ((w - mean).T @ (w - mean)).ravel(), len(w) * np.outer(mean, mean).ravel()])
        return pa.RecordBatch.from_pydict({"v": pa.array([flat.tolist()], pa.list_(pa.float64()))})

    sums = mapped(df, model, ids, vector, rows, "v array<double>").select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).orderBy("at").collect()
    v = np.array([r["x"] for r in sums])
    mean, inner, between = v[:k] / model.n, v[k : k + k * k].reshape(k, k), v[k + k * k :].reshape(k, k)
    return float(np.abs((inner + between) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, ids: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and component."""
    schema = T.StructType([T.StructField("vec_id", df.schema[ids].dataType), *T._parse_datatype_string("component int, n long, deviation long, whitened double, explained double, identity_error double").fields])
    model = fit(df, vector, components)
    if model is None or not len(model.eigenvalues):
        return df.sparkSession.createDataFrame([], schema)
    k, error = len(model.eigenvalues), identity_error(df, model, ids, vector)

    def rows(own: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        m = len(x)
        each = np.repeat(np.arange(m), k)
        return pa.RecordBatch.from_arrays([
            own.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, model.n), pa.int64()), pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
            pa.array(model.whitened(x).ravel()), pa.array(np.tile(model.eigenvalues / model.trace, m)), pa.array(np.full(m * k, error)),
        ], names=schema.names)

    return mapped(df, model, ids, vector, rows, schema)
