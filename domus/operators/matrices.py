"""Small dense matrices of wide tables, summed or reduced over partitions.

* :func:`cross_products` — masked cross products X'X, X'M, M'M (M marks the
  values that are there) of every pair of columns in one pass over the rows,
  from which pairwise-complete correlations follow.
* :func:`triangular_factor` — the R factor of the rows' QR decomposition:
  one per Arrow batch, stacked and factored again up a tree of tasks, so the
  squared condition number of the normal equations never appears.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_AT_ONCE = 16_384  # rows multiplied at a time: bounds the memory of a task at any number of columns
FAN_IN = 64            # factors stacked in one task


def doubles(df: DataFrame, cols: list[str]) -> DataFrame:
    """The columns as doubles c0, c1, …; NaN counts as missing."""
    return df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])


def _matrix(batch: pa.RecordBatch, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a batch as (values with 0 for a missing one, 1 where a value is there)."""
    x = np.empty((hi - lo, batch.num_columns))
    m = np.empty_like(x)
    for i, c in enumerate(batch.columns):
        own = c.slice(lo, hi - lo)
        m[:, i] = own.is_valid().to_numpy(zero_copy_only=False)
        x[:, i] = own.fill_null(0.0).to_numpy(zero_copy_only=False)
    return x, m


# ------------------------------------------------------------ cross products
def cross_products(df: DataFrame, cols: list[str], block: int = 64) -> DataFrame:
    """(a, b, n, sa, sb, saa, sbb, sab) for every two columns by number, a <= b,
    over the rows where both have values: counts, sums, squares and products of
    the values less their column's shift (its first value in the partition would
    differ by task, so one global shift: the column's mean).

    A task holds k x k sums; they are added up over partitions by blocks of
    ``block`` x ``block`` pairs, so no group has more than block² of them."""
    k = len(cols)
    d = doubles(df, cols)
    means = d.agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(k)]).first() if k else []
    shift = np.array([x if x is not None and np.isfinite(x) else 0.0 for x in means])

    def run(batches):
        n, s, q, p = (np.zeros((k, k)) for _ in range(4))
        for b in batches:
            for lo in range(0, b.num_rows, ROWS_AT_ONCE):
                x, m = _matrix(b, lo, min(lo + ROWS_AT_ONCE, b.num_rows))
                x = (x - shift) * m
                n += m.T @ m
                s += x.T @ m        # sum of a where b is there
                q += (x * x).T @ m  # squares of a where b is there
                p += x.T @ x
        for lo in range(0, k, block):
            for at in range(lo, k, block):
                parts = [np.ascontiguousarray(z[lo:lo + block, at:at + block]) for z in (n, s, s.T, q, q.T, p)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lo], pa.int32()), pa.array([at], pa.int32()), *(pa.array([z.tobytes()], pa.binary()) for z in parts)],
                    names=["lo", "at", "n", "sa", "sb", "saa", "sbb", "sab"])

    def add(key, rows):
        lo, at = (x.as_py() for x in key)
        shape = (min(block, k - lo), min(block, k - at))
        total = [sum(np.frombuffer(z, np.float64).reshape(shape) for z in rows.column(c).to_pylist())
                 for c in ("n", "sa", "sb", "saa", "sbb", "sab")]
        a, b = (x.ravel() for x in np.meshgrid(np.arange(lo, lo + shape[0]), np.arange(at, at + shape[1]), indexing="ij"))
        keep = a <= b
        return pa.table({"a": pa.array(a[keep], pa.int32()), "b": pa.array(b[keep], pa.int32()), "n": total[0].ravel()[keep].astype(np.int64),
                         **{c: z.ravel()[keep] for c, z in zip(("sa", "sb", "saa", "sbb", "sab"), total[1:])}})

    partial = d.mapInArrow(run, "lo int, at int, n binary, sa binary, sb binary, saa binary, sbb binary, sab binary")
    return partial.groupBy("lo", "at").applyInArrow(add, "a int, b int, n long, sa double, sb double, saa double, sbb double, sab double")


# ------------------------------------------------------------ QR
def _factor(x: np.ndarray) -> np.ndarray:
    """The upper triangular factor, k x k whatever the number of rows."""
    k = x.shape[1]
    r = np.linalg.qr(x, mode="r") if len(x) else np.zeros((0, k))
    out = np.zeros((k, k))
    out[:len(r)] = r[:k]
    return out


def triangular_factor(df: DataFrame, cols: list[str]) -> tuple[np.ndarray, int]:
    """(R, n): R'R = A'A for the rows A of the columns that have values in all
    of them, and their number.  Factors of partitions meet ``FAN_IN`` at a time
    in tasks until at most that many are left for the driver."""
    k = len(cols)
    d = doubles(df, cols)
    for i in range(k):
        d = d.where(F.col(f"c{i}").isNotNull() & (F.abs(f"c{i}") < float("inf")))
    fields = "part int, n long, r binary"

    def local(batches):
        r, n = np.zeros((k, k)), 0
        for b in batches:
            for lo in range(0, b.num_rows, ROWS_AT_ONCE):
                x, _ = _matrix(b, lo, min(lo + ROWS_AT_ONCE, b.num_rows))
                r, n = _factor(np.vstack([r, x])), n + len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n]), pa.array([r.tobytes()], pa.binary())],
                                             names=["part", "n", "r"])

    def stack(rows):
        rows = rows.sort_by("part")
        r = _factor(np.vstack([np.frombuffer(x, np.float64).reshape(k, k) for x in rows.column("r").to_pylist()]))
        return pa.table({"part": pa.array([rows.column("part")[0].as_py() // FAN_IN], pa.int32()),
                         "n": [sum(rows.column("n").to_pylist())], "r": pa.array([r.tobytes()], pa.binary())})

    parts = d.mapInArrow(local, fields)
    reduced = parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("up")).applyInArrow(stack, fields)
    reduced = reduced.groupBy(F.floor(F.col("part") / FAN_IN).alias("up")).applyInArrow(stack, fields)
    rows = reduced.orderBy("part").collect()  # k x k numbers for every FAN_IN² partitions
    r = _factor(np.vstack([np.zeros((0, k)), *[np.frombuffer(x["r"], np.float64).reshape(k, k) for x in rows]]))
    return r, sum(x["n"] for x in rows)


def independent_columns(r: np.ndarray, tolerance: float = 1e-10) -> list[int]:
    """Columns, in order, that are not a linear combination of those before."""
    kept: list[int] = []
    for j in range(r.shape[1]):
        size = np.linalg.norm(r[:, j])
        own = _factor(r[:, [*kept, j]])
        if size > 0 and abs(own[len(kept), len(kept)]) > tolerance * size:
            kept.append(j)
    return kept
