"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into segments; with segment means m and deviations s,
|x - y|^2 >= sum over segments of len * ((m_x - m_y)^2 + (s_x - s_y)^2), so
x.y = (|x|^2 + |y|^2 - |x - y|^2) / 2 <= sum of len * (m_x m_y + s_x s_y).  The
bound is taken over coarse segments first, then over finer ones, and the exact
product only for pairs that still reach the query's k-th best score so far.

Queries and candidates meet in a grid of cells (query shard x candidate shard)
of bounded size; each cell keeps k rows per query, which a window per query
merges.  Components are integers floor(scale * x), so scores are exact; where
they are so large that products could pass 64 bits, an error is raised.

Vectors that are null or hold null or non-finite components, and null ids, take
no part; vectors are compared with those of their own length only.  Rows that
repeat a vec_id count once, with the smallest of its vectors.  Ties go to the
smaller vec_id.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from domus.llm.common import table

SEGMENTS = (16, 4, 2)  # components per segment, coarse to fine
CELL_CANDIDATES = 16_384
CELL_QUERIES = 16_384
TILE = 2_048
QUERY_BLOCK = 256


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v array<long>) of the vectors that take part, one per vec_id."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    v = F.transform("embedding", lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    return rows.select("vec_id", v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(rows: pa.Table, dim: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in rows.column("v").chunks])
    return np.asarray(flat.to_numpy(zero_copy_only=False), np.int64).reshape(len(rows), dim)


def segment_features(x: np.ndarray, width: int) -> np.ndarray:
    """[sqrt(len) * mean, sqrt(len) * deviation] of every segment: their inner
    products are upper bounds of those of the vectors."""
    parts = []
    for lo in range(0, x.shape[1], width):
        s = x[:, lo:lo + width]
        root = np.sqrt(s.shape[1])
        parts += [root * s.mean(axis=1), root * s.std(axis=1)]
    return np.stack(parts, axis=1) if parts else np.zeros((len(x), 1))


class BestSoFar:
    """The k best (score, id) of every query of a block."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.ident = np.zeros(0, np.int64)
        self.limit = np.full(n, -np.inf)

    def add(self, query, score, ident):
        q, s, i = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.ident, ident)))
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        first = np.searchsorted(q, q, side="left")
        rank = np.arange(len(q)) - first
        keep = rank < self.k
        self.query, self.score, self.ident = q[keep], s[keep], i[keep]
        last = rank == self.k - 1
        self.limit[q[last]] = s[last]


def search_cell(q_ids, q, c_ids, c, k: int) -> tuple:
    """(query number, score, vec_id) of the k best candidates of a cell for each
    of its queries, exactly.  A block of queries keeps its own small table."""
    qf, cf = q.astype(np.float64), c.astype(np.float64)
    reach = float(np.abs(qf).max(initial=0)) * float(np.abs(cf).max(initial=0)) * q.shape[1]
    if reach >= 2.0 ** 63:
        raise ValueError("components are so large that inner products pass 64 bits")
    levels = [w for w in SEGMENTS if w < q.shape[1]]
    qs, cs = [segment_features(qf, w) for w in levels], [segment_features(cf, w) for w in levels]
    slack = 1e-9 * np.sqrt(np.einsum("ij,ij->i", qf, qf)) * (np.sqrt(np.einsum("ij,ij->i", cf, cf)).max() if len(c) else 0) + 1e-6
    parts = [(np.zeros(0, np.int64),) * 3]
    for qlo in range(0, len(q), QUERY_BLOCK):
        qat = slice(qlo, qlo + QUERY_BLOCK)
        best = BestSoFar(len(q[qat]), k)
        for lo in range(0, len(c), TILE):
            at = slice(lo, lo + TILE)
            floor = (best.limit - slack[qat])[:, None]
            own = q_ids[qat][:, None] != c_ids[at][None, :]
            for coarse, fine in zip(qs, cs, strict=True):
                cols = np.flatnonzero(own.any(axis=0))  # candidates that some query of the tile still needs
                if 2 * len(cols) > own.shape[1]:
                    own &= coarse[qat] @ fine[at].T >= floor
                else:
                    own[:, cols] &= coarse[qat] @ fine[at][cols].T >= floor
            if reach < 2.0 ** 53 and 20 * np.count_nonzero(own) > own.size:
                # products of integers below 2**53 are exact in doubles
                score = qf[qat] @ cf[at].T
                own &= score >= best.limit[:, None]
                i, j = np.nonzero(own)
                best.add(i, score[i, j].astype(np.int64), c_ids[at][j])
                continue
            i, j = np.nonzero(own)
            for a in range(0, len(i), 65536):
                x, y = i[a:a + 65536], j[a:a + 65536] + lo
                score = np.einsum("ij,ij->i", q[x + qlo], c[y])
                ok = score >= best.limit[x]
                best.add(x[ok], score[ok], c_ids[y[ok]])
        parts.append((best.query + qlo, best.score, best.ident))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows that the condition ``is_query``
    on vec_id selects, against every other row."""
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, scale).withColumn("dim", F.size("v"))
    n, n_q = vectors.agg(F.count(F.lit(1)), F.count(F.when(is_query, F.lit(1)))).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    c_shards, q_shards = max(parts, -(-n // CELL_CANDIDATES)), max(1, -(-n_q // CELL_QUERIES))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = rows.select("dim", F.pmod(F.xxhash64("vec_id"), F.lit(c_shards)).cast("int").alias("c"), every(q_shards).alias("q"), "vec_id", "v")
    right = rows.filter(is_query).select("dim", every(c_shards).alias("c"),
                                         F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(q_shards)).cast("int").alias("q"), "vec_id", "v")

    def cell(key, cand, quer):
        dim = key[0].as_py()
        if not len(cand) or not len(quer) or dim is None:
            empty = pa.array([], pa.int64())
            return pa.table({"query_id": empty, "vec_id": empty, "score": empty})
        quer = quer.sort_by("vec_id")
        cand = cand.sort_by("vec_id")
        q_ids, c_ids = (t.column("vec_id").to_numpy().astype(np.int64) for t in (quer, cand))
        number, score, ident = search_cell(q_ids, _matrix(quer, dim), c_ids, _matrix(cand, dim), k)
        return pa.table({"query_id": q_ids[number], "vec_id": ident, "score": score})

    keys = ["dim", "c", "q"]
    cells = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return cells.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
