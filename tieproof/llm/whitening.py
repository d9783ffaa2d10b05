"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Entries are numbers on a grid, so sums are exact and do not depend on how rows
were dealt to tasks. Two passes over the vectors give the sums per dimension and
the scatter around whole numbers close to the means; what the driver holds is one
matrix of dimension x dimension. A third pass measures how far the covariance of
the whitened vectors is from the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieproof.llm.tables import query, table

SCALE, SHIFT = 1024, 100_000
#: Entries at or above this size are no numbers of an embedding; their grid value would leave 64 bits.
LARGEST = float(1 << 50)
ROWS = 4096
LIMB = 16


def grid(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their grid values as rows x ``dim`` long)."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(vectors.offsets.to_numpy().astype(np.int64))
    size[vectors.is_null().to_numpy(zero_copy_only=False)] = 0
    right = size == dim
    x = flat[np.repeat(right, size)].reshape(-1, dim)
    with np.errstate(invalid="ignore"):
        good = (np.abs(x) < LARGEST).all(1)
    return np.flatnonzero(right)[good], np.floor(x[good] * SCALE).astype(np.int64) + SHIFT


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            yield b.slice(lo, ROWS)


def _whole(c: Column) -> Column:
    return F.sum(c).cast("decimal(38,0)")


def dimension(vectors: DataFrame) -> int | None:
    """The most frequent length of the vectors that hold only usable numbers; of several the smallest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for b in _parts(batches):
            v = b.column(0)
            flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            size = np.diff(v.offsets.to_numpy().astype(np.int64))
            size[v.is_null().to_numpy(zero_copy_only=False)] = 0
            with np.errstate(invalid="ignore"):
                bad = np.concatenate([[0], np.cumsum(~(np.abs(flat) < LARGEST))])
            end = np.cumsum(size)
            good = (size > 0) & (bad[end] == bad[end - size])
            for d, n in zip(*np.unique(size[good], return_counts=True)):
                counts[int(d)] = counts.get(int(d), 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.int32()), pa.array(counts.values(), pa.int64())], ["dim", "n"])

    found = vectors.select("embedding").mapInArrow(run, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n"))
    first = found.orderBy(F.desc("n"), "dim").first()
    return first and first["dim"]


def sums(vectors: DataFrame, dim: int) -> tuple[int, list[int]]:
    """(number of vectors, exact sum per dimension)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for b in _parts(batches):
            x = grid(b.column(0), dim)[1]
            n += len(x)
            high, low = x >> 32, x & 0xFFFFFFFF
            total = [t + (int(h) << 32) + int(lo) for t, h, lo in zip(total, high.sum(0), low.sum(0))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *range(dim)], pa.int32()), pa.array([Decimal(n), *map(Decimal, total)], pa.decimal128(38, 0))], ["i", "s"])

    rows = vectors.select("embedding").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(_whole(F.col("s")).alias("s")).collect()
    got = {r["i"]: int(r["s"]) for r in rows}
    return got.get(-1, 0), [got.get(i, 0) for i in range(dim)]


def scatter(vectors: DataFrame, n: int, total: list[int]) -> list[list[int]]:
    """``n`` times the scatter around the mean, exactly and in whole numbers: ``n`` squared times the covariance.

    Vectors are centred on the whole numbers next to their means, multiplied, and
    what that leaves of the mean is taken off in whole numbers. Differences are
    multiplied as digits of ``LIMB`` bits, so no product leaves 64 bits. A task
    sends ``dim`` rows a pair of digits; ordinary vectors have one digit.
    """
    dim = len(total)
    near = [(2 * s + n) // (2 * n) for s in total]
    near_row = np.array(near, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sum_of: dict[int, np.ndarray] = {}
        for b in _parts(batches):
            y = grid(b.column(0), dim)[1] - near_row
            digits = []
            while y.any():  # signed digits: the last one carries the sign
                digit = ((y + (1 << (LIMB - 1))) & ((1 << LIMB) - 1)) - (1 << (LIMB - 1))
                digits.append(digit.astype(np.float64))
                y = (y - digit) >> LIMB
            for p, left in enumerate(digits):
                for q, right in enumerate(digits):  # below 2 ** 53, so floats are exact
                    sum_of[p + q] = sum_of.get(p + q, 0) + (left.T @ right).astype(np.int64)
        lines = pa.array(np.arange(dim + 1) * dim, pa.int32())
        for e, m in sum_of.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(dim, e), pa.int32()), pa.array(np.arange(dim), pa.int32()),
                 pa.ListArray.from_arrays(lines, pa.array(m.reshape(-1)))], ["e", "i", "m"])

    def add(t: pa.Table) -> pa.Table:
        m = np.zeros(dim, object)
        for row in t.column("m").to_pylist():
            m += np.array(row, object)
        return pa.table({"e": t.column("e")[:1], "i": t.column("i")[:1],
                         "m": pa.array([[Decimal(v) for v in m]], pa.list_(pa.decimal128(38, 0)))})

    parts = vectors.select("embedding").mapInArrow(run, "e int, i int, m array<long>")
    rows = parts.groupBy("e", "i").applyInArrow(add, "e int, i int, m array<decimal(38,0)>").collect()
    out = [[-(total[i] - n * near[i]) * (total[j] - n * near[j]) for j in range(dim)] for i in range(dim)]
    for r in rows:
        line = out[r["i"]]
        for j, v in enumerate(r["m"]):
            line[j] += n * (int(v) << (LIMB * r["e"]))
    return out


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``g`` of dim x rank with ``g g' = a``: a lower triangular factor with its rows in their old order.

    Each step takes the largest diagonal entry left; the rank is reached when what
    is left is no more than rounding of the largest one.
    """
    dim = len(a)
    left, g = np.array(np.diag(a), float), np.zeros((dim, 0))
    least = dim * np.finfo(float).eps * max(left.max(initial=0), 0)
    while g.shape[1] < dim:
        p = int(np.argmax(left))
        if left[p] <= least:
            break
        column = (a[:, p] - g @ g[p]) / np.sqrt(left[p])
        left = left - column ** 2
        left[p] = -np.inf
        g = np.column_stack([g, column])
    return g


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of ``n`` columns once, in rounds of disjoint pairs: all but the first walk around a table."""
    seats = list(range(n + n % 2))
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], seats[:half - 1:-1]) if a < n and b < n]
        yield np.array([min(p) for p in pairs], int), np.array([max(p) for p in pairs], int)
        seats = [seats[0], seats[-1], *seats[1:-1]]


def jacobi(g: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``g g'``, falling, and its eigenvectors as columns, by rotating the columns of ``g``.

    Pairs of columns are turned until all are at right angles to within rounding:
    then their squared norms are eigenvalues and their directions components.
    """
    g = g.copy()
    rounding = len(g) * np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for p, q in _rounds(g.shape[1]):
            x, y = g[:, p], g[:, q]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            open_ = np.abs(c) > rounding * np.sqrt(a * b)
            swap = a < b  # larger norms come to the front
            if not (open_ | swap).any():
                continue
            turned = turned or bool(open_.any())
            with np.errstate(divide="ignore", invalid="ignore"):
                zeta = (b - a) / (2 * c)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(open_, t, 0.0)
            cos = 1 / np.sqrt(1 + t * t)
            sin = cos * t
            x, y = cos * x - sin * y, sin * x + cos * y
            back = (x * x).sum(0) < (y * y).sum(0)
            g[:, p], g[:, q] = np.where(back, y, x), np.where(back, x, y)
        if not turned:
            break
    values = (g * g).sum(0)
    order = np.argsort(-values, kind="stable")
    values = values[order]
    return values, g[:, order] / np.sqrt(values)


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with ``sums``; ``values`` falling eigenvalues of their covariance, ``components`` as columns, ``trace`` of it."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of grid values: centred on whole numbers first, so that nothing cancels."""
        near = [s // self.n for s in self.sums]
        rest = np.array([(s - self.n * m) / self.n for s, m in zip(self.sums, near)])
        y = (x - np.array(near, np.int64)).astype(np.float64) - rest
        return y @ (self.components / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[Decimal]:
        """Exactly the sum over dimensions of ``(n x - S) ** 2`` of each row."""
        near = [s // self.n for s in self.sums]
        y, rest = x - np.array(near, np.int64), [s - self.n * m for s, m in zip(self.sums, near)]
        most = max(int(np.abs(y).max(initial=0)) * self.n + self.n, 1)
        if most * most * self.dim < 1 << 62:
            u = y * self.n - np.array(rest, np.int64)
            return [Decimal(v) for v in (u * u).sum(1).tolist()]
        u = y.astype(object) * self.n - np.array(rest, object)
        return [Decimal(v) for v in (u * u).sum(1)]


def fit(vectors: DataFrame, components: int = 8) -> Whitening | None:
    """The first ``components`` of all usable ``embedding`` of ``vectors``; None without usable vectors.

    Usable: not null, of the most frequent length (:func:`dimension`), without null,
    non-finite or absurd entries (``LARGEST``). Directions without variance are no
    components, so there can be fewer, and none of equal vectors.
    """
    dim = dimension(vectors)
    if dim is None:
        return None
    n, total = sums(vectors, dim)
    exact = scatter(vectors, n, total)
    v = np.array([[m / (n * n) for m in line] for line in exact])
    values, directions = jacobi(pivoted_cholesky(v))
    trace = sum(exact[i][i] for i in range(dim)) / (n * n)
    return Whitening(n, tuple(total), values[:components], directions[:, :components], trace)


def identity_error(vectors: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity, measured on all of them."""
    k = len(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for b in _parts(batches):
            w = fitted.project(grid(b.column(0), fitted.dim)[1])
            first, second = first + w.sum(0), second + w.T @ w
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([np.full(k, -1), np.repeat(np.arange(k), k)]), pa.int32()),
            pa.array(np.concatenate([np.arange(k), np.tile(np.arange(k), k)]), pa.int32()),
            pa.array(np.concatenate([first, second.reshape(-1)]))], ["i", "j", "s"])

    if not k:
        return 0.0
    rows = vectors.select("embedding").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    got = {(r["i"], r["j"]): r["s"] / fitted.n for r in rows}
    return max(abs(got[i, j] - got[-1, i] * got[-1, j] - (i == j)) for i in range(k) for j in range(k))


def whiten(vectors: DataFrame, fitted: Whitening) -> DataFrame:
    """``vec_id, deviation, whitened`` of every usable row of ``vectors`` (``vec_id``, ``embedding``).

    ``whitened`` has one entry a component. Rows with a null or repeated id stay as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            rows, x = grid(b.column(1), fitted.dim)
            w = fitted.project(x)
            at = pa.array(np.arange(len(rows) + 1) * w.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows)), pa.array(fitted.deviations(x), pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(at, pa.array(w.reshape(-1)))], ["vec_id", "deviation", "whitened"])

    rows = vectors.select("vec_id", "embedding")
    key = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {key}, deviation decimal(38,0), whitened array<double>")


def components_of(vectors: DataFrame, components: int = 8) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact``: a row per vector and component.

    ``deviation`` is null where it leaves 64 bits (from some 10^8 vectors on);
    ``deviation_exact`` always holds it. An empty table, or one of equal vectors,
    which vary in no direction, gives no rows.
    """
    fitted = fit(vectors, components)
    if fitted is None or not len(fitted.values):
        key = vectors.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame(
            [], f"vec_id {key}, component int, n long, deviation long, whitened double, explained double, "
                "identity_error double, deviation_exact decimal(38,0)")
    share = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.values])
    rows = whiten(vectors, fitted).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"), "whitened", share[F.col("at")].alias("explained"),
        F.lit(identity_error(vectors, fitted)).alias("identity_error"), F.col("deviation").alias("deviation_exact"))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark, folder):
    return components_of(table(spark, folder, "embeddings", "vec_id", "embedding"))
