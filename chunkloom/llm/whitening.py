"""Embedding whitening by spectrum slicing.

Three passes over the vectors give small sums: number and totals, the covariance, and the covariance of what was
whitened. The covariance, a square of the vectors' length, is taken apart on the driver: the number of negative pivots
of the LDL' factors of ``V - s`` is the number of eigenvalues below ``s``, so halving shifts isolate each leading
eigenvalue; Rayleigh quotient iteration converges to it from inside its slice; counts on both sides of the result
certify its number. Eigenvalues too close to be told apart are numbered together, and their vectors made orthogonal.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import with_columns_renamed

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LIMIT = 2.0**53  # integers from here on are not exact as doubles
EPS = float(np.finfo(np.float64).eps)


# ---------------------------------------------------------------- spectrum of one symmetric matrix


class Factors:
    """P A P' = L D L' with pivots of one or two rows (Bunch and Kaufman); D has the inertia of A."""

    def __init__(self, matrix: np.ndarray, tiny: float):
        a = np.array(matrix)
        n = len(a)
        self.order = np.arange(n)
        self.blocks: list[tuple[int, int]] = []
        alpha = (1 + 17**0.5) / 8
        k = 0
        while k < n:
            size = 1
            if k + 1 < n:
                column = np.abs(a[k + 1 :, k])
                r = k + 1 + int(column.argmax())
                most = column[r - k - 1]
                if abs(a[k, k]) < alpha * most:
                    row = np.abs(a[r, k:])
                    row[r - k] = 0
                    other = row.max()
                    if abs(a[k, k]) * other < alpha * most * most:
                        size = 1 if abs(a[r, r]) >= alpha * other else 2
                        self._swap(a, k + size - 1, r)
            if size == 1:
                if abs(a[k, k]) < tiny:
                    a[k, k] = tiny
                rest = a[k + 1 :, k] / a[k, k]
                a[k + 1 :, k + 1 :] -= np.outer(rest, a[k + 1 :, k])
                a[k + 1 :, k] = rest
            else:
                pivot = a[k : k + 2, k : k + 2].copy()
                rest = a[k + 2 :, k : k + 2] @ np.linalg.inv(pivot)
                a[k + 2 :, k + 2 :] -= rest @ a[k + 2 :, k : k + 2].T
                a[k + 2 :, k : k + 2] = rest
            self.blocks.append((k, size))
            k += size
        self.a = a

    def _swap(self, a: np.ndarray, i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            self.order[[i, j]] = self.order[[j, i]]

    def negative(self) -> int:
        """Number of negative eigenvalues. A pivot of two rows has one of each sign."""
        return sum(1 if size == 2 else int(self.a[k, k] < 0) for k, size in self.blocks)

    def solve(self, b: np.ndarray) -> np.ndarray:
        a, x = self.a, b[self.order].copy()
        for k, size in self.blocks:
            x[k + size :] -= a[k + size :, k : k + size] @ x[k : k + size]
        for k, size in self.blocks:
            x[k : k + size] = x[k] / a[k, k] if size == 1 else np.linalg.solve(a[k : k + 2, k : k + 2], x[k : k + 2])
        for k, size in reversed(self.blocks):
            x[k : k + size] -= a[k + size :, k : k + size].T @ x[k + size :]
        out = np.empty_like(x)
        out[self.order] = x
        return out


def leading(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, int]:
    """The largest eigenvalues, falling, their unit vectors as rows, and the number of counts that were made.

    Only eigenvalues above rounding are given (a matrix of low rank has fewer). The sign of a vector is that which
    makes its largest entry, the first of equal ones, positive.
    """
    n = len(matrix)
    norm = float(np.abs(matrix).sum(axis=1).max()) if n else 0.0
    if not n or norm == 0:
        return np.zeros(0), np.zeros((0, n)), 0
    tiny, floor, near = EPS * norm * 1e-3, 4 * n * EPS * norm, 8 * n * EPS * norm
    counts: dict[float, int] = {}
    eye = np.eye(n)

    def above(shift: float) -> int:
        """Number of eigenvalues above ``shift``."""
        if shift not in counts:
            counts[shift] = n - Factors(matrix - shift * eye, tiny).negative()
        return counts[shift]

    k = min(wanted, above(floor))
    values, vectors = np.zeros(0), np.zeros((0, n))
    rng = np.random.default_rng(1)
    top = norm * (1 + 4 * EPS)
    counts[top] = 0
    while len(values) < k:
        done = len(values)
        # The narrowest known slice (low, high] that begins with the next eigenvalue.
        high = min(s for s, c in counts.items() if c <= done)
        low = max(s for s, c in counts.items() if c > done)
        while above(low) - done > 1 and high - low > near:
            middle = (low + high) / 2
            if above(middle) <= done:
                high = middle
            else:
                low = middle
        together = above(low) - done
        if together > 1:
            # No shift tells these apart; inverse iteration from their slice, each orthogonal to the others.
            solver = Factors(matrix - (low + high) / 2 * eye, tiny)
            for _ in range(min(together, k - done)):
                v = _settled(lambda x: solver.solve(x), vectors, rng.standard_normal(n), rounds=4)
                values, vectors = np.append(values, v @ matrix @ v), np.vstack([vectors, v])
            continue
        close = vectors[values - high < 1e-3 * norm] if done else vectors
        while True:
            solver = Factors(matrix - (low + high) / 2 * eye, tiny)
            v = _settled(solver.solve, close, rng.standard_normal(n), rounds=2)
            for _ in range(12):
                rho = float(v @ matrix @ v)
                if np.linalg.norm(matrix @ v - rho * v) <= n * EPS * norm / 8:
                    break
                v = _settled(Factors(matrix - rho * eye, tiny).solve, close, v, rounds=1)
            rho = float(v @ matrix @ v)
            # Certified if exactly ``done`` eigenvalues lie above and this one does not lie below.
            if above(rho + near) <= done < above(rho - near):
                break
            if high - low <= near:
                raise ArithmeticError("an eigenvalue could not be certified")
            middle = (low + high) / 2
            low, high = (low, middle) if above(middle) <= done else (middle, high)
        values, vectors = np.append(values, rho), np.vstack([vectors, v])
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[order]
    signs = np.sign(vectors[np.arange(k), np.abs(vectors).argmax(axis=1)]) if k else np.zeros(0)
    return values, vectors * signs[:, None], len(counts)


def _settled(step: Callable[[np.ndarray], np.ndarray], others: np.ndarray, v: np.ndarray, rounds: int) -> np.ndarray:
    for _ in range(rounds):
        v = step(v)
        v = v / np.abs(v).max()
        for _ in range(2):
            v = v - others.T @ (others @ v)
        v = v / np.linalg.norm(v)
    return v


# ---------------------------------------------------------------- passes over the vectors


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, without null or non-finite entries, entries small enough for exact integers."""
    limit = F.lit((LIMIT / 2 - SHIFT) / SCALE)
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) >= limit))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    """The x of each vector, one row each."""
    flat = pc.cast(pc.list_flatten(column), pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat.reshape(-1, dim)).astype(np.int64) + SHIFT


def _sums(rows: DataFrame, dim: int, make: Callable[[Iterator[np.ndarray]], np.ndarray], width: int) -> np.ndarray:
    """Partial sums of each task (``width`` wide rows of doubles), added up by row in the order of the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        total = make(_integers(b.column("vector"), dim) for b in batches if b.num_rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.array(np.full(len(total), part)), pa.array(list(total), pa.list_(pa.float64()))],
            ["i", "part", "sums"],
        )

    partial = rows.select("vector").mapInArrow(run, "i long, part long, sums array<double>")

    def add(table: pa.Table) -> pa.Table:
        ordered = table.sort_by("part")
        total = np.stack(ordered.column("sums").to_numpy()).sum(axis=0)
        return pa.table({"i": ordered.column("i").slice(0, 1), "sums": pa.array([total], pa.list_(pa.float64()))})

    # One row for each dimension; a group holds one row of each task.
    found = partial.groupBy("i").applyInArrow(add, "i long, sums array<double>").collect()
    out = np.zeros((max((r["i"] for r in found), default=-1) + 1, width))
    for r in found:
        out[r["i"]] = r["sums"]
    return out


def whiten(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error: one row for each vector and component.

    Entries become integers x = floor(64 c) + 1000000. Vectors that are null, hold null or non-finite entries, or
    entries too large for exact integers take no part, nor do those that are not of the most frequent length (the
    greater of equally frequent ones). Rows with repeated or null ids each count. There are as many components as
    asked for, or as the covariance has eigenvalues above rounding: none for one vector, equal vectors or an empty
    table. Further columns are ignored. What comes to the driver is a square of the vectors' length.
    """
    rows = with_columns_renamed(rows, id_column, vector_column).toDF("vec_id", "vector")
    rows = rows.where(usable(F.col("vector")))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).head(1)
    nothing = rows.sparkSession.createDataFrame([], schema)
    if not lengths or not lengths[0]["dim"]:
        return nothing
    dim, n = lengths[0]["dim"], lengths[0]["count"]
    rows = rows.where(F.size("vector") == dim)
    # Exact totals: each entry as a long, summed by position.
    entry = F.floor(F.col("c").cast("double") * SCALE).cast("long") + SHIFT
    totals = rows.select(F.posexplode("vector").alias("d", "c")).groupBy("d").agg(F.sum(entry).alias("s")).collect()
    total = [s for _, s in sorted((r["d"], r["s"]) for r in totals)]
    # The mean as an integer and a fraction, so that nothing is lost in the difference.
    whole, part = np.array([s // n for s in total]), np.array([s % n / n for s in total])

    def covariance(batches: Iterator[np.ndarray]) -> np.ndarray:
        out = np.zeros((dim, dim))
        for x in batches:
            y = (x - whole) - part
            out += y.T @ y
        return out

    v = _sums(rows, dim, covariance, dim) / n
    v = (v + v.T) / 2
    values, vectors, _ = leading(v, components)
    k = len(values)
    if not k:
        return nothing
    scaled = vectors / np.sqrt(values)[:, None]

    def moments(batches: Iterator[np.ndarray]) -> np.ndarray:
        """Number, sums and products about the mean of the whitened rows, batch after batch (Chan's update)."""
        count, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for x in batches:
            w = ((x - whole) - part) @ scaled.T
            m, mid = len(w), w.mean(axis=0)
            apart = mid - mean
            products += (w - mid).T @ (w - mid) + np.outer(apart, apart) * (count * m / (count + m))
            mean = mean + apart * (m / (count + m))
            count += m
        # The share of this task in the sum about the mean of all, which is zero but for rounding.
        return products + np.outer(mean, mean) * count

    error = float(np.abs(_sums(rows, dim, moments, k) / n - np.eye(k)).max())
    explained = values / np.trace(v)
    exact = np.array(total, dtype=object)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _integers(batch.column("vector"), dim)
            w = ((x - whole) - part) @ scaled.T
            # n x - S is n (x - S // n) - S % n; long integers where the sum of squares fits, else without limit.
            y = x - whole
            most = n * (int(np.abs(y).max()) + 1)
            if dim * most * most < 2**63:
                deviation = ((n * y - np.array([s % n for s in total])) ** 2).sum(axis=1).tolist()
            else:
                deviation = [d if d < 2**63 else None for d in ((n * x.astype(object) - exact) ** 2).sum(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(deviation, pa.int64()), pa.array(list(w), pa.list_(pa.float64()))],
                ["vec_id", "deviation", "w"],
            )

    ready = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "vector").mapInArrow(project, "vec_id long, deviation long, w array<double>")
    shares = F.array(*[F.lit(float(e)) for e in explained])
    return ready.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
