"""Centroid clustering (Lloyd's rounds) with geometric drift tightening.

Vectors are kept with exactly ``dims`` components, none null or non-finite, and
become integers floor(scale * x).  Every distance that decides or is returned
is an exact integer; floating point is used for bounds only, rounded to the
safe side.  A component beyond 2**27 after scaling raises an error (its squared
distances would pass 64 bits).

A round reads blocks of packed vectors with, per vector, its cluster, the exact
distance to that centroid and a lower bound of the distance to all others, and
writes them anew.  When the centroids have moved, the members of a cluster in a
block lie in a sphere around the old centroid.  Another centroid that moved
from p to q can have come nearer to a point x of that sphere by |x-p| - |x-q|
at most; the points where this is t or more lie inside one branch of a hyperbola
with the foci p and q, so inside the cone around the direction of the move with
the opening angle arccos(t / |q-p|) at the middle of p and q.  In the plane of p, q
and the sphere's centre the smallest angle of the sphere seen from there gives
the bound: |q-p| times its cosine, nothing if the sphere lies behind.  The lower
bound loses the largest such amount over the other centroids rather than the
largest drift.  A vector whose exact new distance to its own centroid is below
the bound keeps its cluster; every other one is compared with all centroids.

Rounds are written to the shared folder and removed when the next one stands.
Sums travel once per partition and cluster; k x dims numbers reach the driver.

No kept vector: no rows.  Fewer than k: as many centroids.  Repeated rows are
vectors of their own; equal ids are ordered by their components where the first
centroids are chosen, a null id comes last there and stays null.  All columns
but the id and the vector are ignored.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm import blocks as B
from domus.llm.common import remove_folder, shared_dir, table

K = 40
ROUNDS = 5
DIMS = 64
SCALE = 256
BLOCK_ROWS = 8192
LIMIT = 1 << 27  # largest component: squared distances of up to 64 components stay below 2**63
EXACT = 1 << 22  # up to here products add up exactly in double precision
SLACK = 1e-9

_STATE = "ids binary, nulls binary, vectors binary, cluster_of binary, distance binary, lower binary"
_SUMS = "cluster int, n long, inertia decimal(38,0), sums array<long>, scanned long"


# ------------------------------------------------------------ vectors
def kept_vectors(df: DataFrame, dims: int = DIMS, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id long and v array<double>: the vectors that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where((F.size("v") == dims) & usable)


def quantise(x: np.ndarray, scale: int) -> np.ndarray:
    q = np.floor(x * scale)
    if q.size and np.abs(q).max() > LIMIT:
        raise ValueError(f"a component is larger than {LIMIT} after scaling")
    return q.astype(np.int64)


def first_centroids(vectors: DataFrame, k: int, scale: int, salt: str = "2:") -> np.ndarray:
    h = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(h.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()  # k rows
    return quantise(np.array([r["v"] for r in rows], np.float64), scale)


def squared_distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the integer vectors to the integer centroids."""
    if max(np.abs(v).max(initial=0), np.abs(c).max(initial=0)) <= EXACT:
        cross = (v.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
        return (v * v).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * cross
    return np.stack([((v - x) ** 2).sum(1) for x in c], axis=1)


# ------------------------------------------------------------ bounds
def approach(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For points within ``radius`` of ``centre``, the most by which the
    distance to a centroid can have shrunk when it moved from old to new (rows)."""
    move = new - old
    drift = np.linalg.norm(move, axis=1)
    seen = centre - (old + new) / 2
    far = np.linalg.norm(seen, axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.einsum("ij,ij->i", seen, move) / (far * drift)
        width = np.arcsin(np.minimum(1.0, radius * (1 + SLACK) / far))
    angle = np.arccos(np.clip(cosine, -1, 1)) - width - 1e-7
    nearer = drift * np.cos(np.clip(angle, 0, np.pi / 2))
    return np.where((far <= radius * (1 + SLACK)) | (drift == 0), drift, np.minimum(nearer, drift)) * (1 + SLACK)


def loosening(own: np.ndarray, distance: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Per cluster: what its members' lower bounds lose in this block."""
    out = np.zeros(len(old))
    for i in np.unique(own).tolist():
        others = np.arange(len(old)) != i
        if others.any():
            radius = float(np.sqrt(distance[own == i].max())) * (1 + SLACK)
            out[i] = approach(old[i], radius, old[others], new[others]).max()
    return out


def scan(v: np.ndarray, c: np.ndarray) -> tuple:
    """Nearest centroid (the smaller number of equals), exact distance and a
    lower bound of the distance to the others."""
    d = squared_distances(v, c)
    own = d.argmin(axis=1)
    rows = np.arange(len(v))
    best = d[rows, own]
    if len(c) == 1:
        return own, best, np.full(len(v), np.inf)
    d[rows, own] = np.iinfo(np.int64).max
    return own, best, np.sqrt(d.min(axis=1).astype(np.float64)) * (1 - SLACK)


def reassign(v, own, distance, lower, old, new) -> tuple:
    """The state under the moved centroids, and how many vectors were scanned."""
    lower = lower - loosening(own, distance, old.astype(np.float64), new.astype(np.float64))[own] - SLACK
    distance = np.empty(len(v), np.int64)
    for i in np.unique(own).tolist():
        distance[own == i] = squared_distances(v[own == i], new[i:i + 1])[:, 0]
    unsure = np.flatnonzero(np.sqrt(distance.astype(np.float64)) * (1 + SLACK) >= lower)
    own = own.copy()
    own[unsure], distance[unsure], lower[unsure] = scan(v[unsure], new)
    return own, distance, lower, len(unsure)


# ------------------------------------------------------------ rounds
def _schema(fields: str) -> pa.Schema:
    kinds = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "decimal(38,0)": pa.decimal128(38, 0), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in fields.split(", ")])


class _Sums:
    """A partition's sums by cluster, as one row each."""

    def __init__(self, k: int, dims: int):
        self.n, self.scanned = np.zeros(k, np.int64), np.zeros(k, np.int64)
        self.inertia, self.sums = [0] * k, [[0] * dims for _ in range(k)]

    def add(self, v, own, distance, scanned) -> None:
        for i in np.unique(own).tolist():
            at = own == i
            self.n[i] += int(at.sum())
            # a block's distances may pass 64 bits together: high and low halves apart
            d = distance[at]
            self.inertia[i] += (int((d >> 32).sum()) << 32) + int((d & 0xFFFFFFFF).sum())
            self.sums[i] = [a + b for a, b in zip(self.sums[i], v[at].sum(axis=0).tolist(), strict=True)]
        self.scanned[0] += scanned

    def batch(self) -> pa.RecordBatch:
        own = np.flatnonzero((self.n > 0) | (self.scanned > 0))
        cols = [pa.array(own, pa.int32()), pa.array(self.n[own]), pa.array([Decimal(self.inertia[i]) for i in own], pa.decimal128(38, 0)),
                pa.array([self.sums[i] for i in own], pa.list_(pa.int64())), pa.array(self.scanned[own])]
        blank = [pa.nulls(len(own), pa.binary())] * 6
        return pa.RecordBatch.from_arrays([*blank, *cols], schema=_schema(f"{_STATE}, {_SUMS}"))


def _block(ids, nulls, v, own, distance, lower) -> pa.RecordBatch:
    raw = [ids, nulls, v, own.astype(np.int32), distance, lower]
    cols = [pa.array([B.compress(np.ascontiguousarray(x).tobytes())], pa.binary()) for x in raw]
    blank = [pa.nulls(1, f.type) for f in _schema(_SUMS)]
    return pa.RecordBatch.from_arrays([*cols, *blank], schema=_schema(f"{_STATE}, {_SUMS}"))


def _unpack(r: dict, dims: int) -> tuple:
    kinds = (np.int64, np.bool_, np.int32, np.int32, np.int64, np.float64)
    ids, nulls, v, own, distance, lower = (np.frombuffer(B.decompress(r[c.split()[0]]), t) for c, t in zip(_STATE.split(", "), kinds, strict=True))
    return ids, nulls, v.reshape(-1, dims).astype(np.int64), own.astype(np.int64), distance, lower


def start(vectors: DataFrame, centroids: np.ndarray, scale: int) -> DataFrame:
    """Blocks of the vectors, all compared with the first centroids."""
    k, dims = centroids.shape

    def run(batches):
        sums = _Sums(k, dims)
        for b in batches:
            x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            ids = b.column("vec_id")
            for lo in range(0, len(x), BLOCK_ROWS):
                v = quantise(x[lo:lo + BLOCK_ROWS], scale)
                own, distance, lower = scan(v, centroids)
                sums.add(v, own, distance, len(v))
                part = ids.slice(lo, len(v))
                yield _block(part.fill_null(0).to_numpy(zero_copy_only=False), part.is_null().to_numpy(zero_copy_only=False),
                             v.astype(np.int32), own, distance, lower)
        yield sums.batch()

    return vectors.mapInArrow(run, f"{_STATE}, {_SUMS}")


def next_round(state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
    k, dims = new.shape

    def run(batches):
        sums = _Sums(k, dims)
        for b in batches:
            for r in b.to_pylist():
                ids, nulls, v, own, distance, lower = _unpack(r, dims)
                own, distance, lower, scanned = reassign(v, own, distance, lower, old, new)
                sums.add(v, own, distance, scanned)
                yield _block(ids, nulls, v.astype(np.int32), own, distance, lower)
        yield sums.batch()

    names = [f.split()[0] for f in _STATE.split(", ")]
    return state.where("cluster is null").select(*names).mapInArrow(run, f"{_STATE}, {_SUMS}")


def cluster_sums(state: DataFrame, k: int, dims: int) -> tuple:
    """Per cluster, over all blocks: count, inertia, sums; and the vectors scanned."""
    rows = state.where("cluster is not null")
    sums = [[0] * dims for _ in range(k)]
    parts = rows.select("cluster", F.posexplode("sums").alias("pos", "x")).groupBy("cluster", "pos").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    for r in parts.collect():  # k x dims rows
        sums[r["cluster"]][r["pos"]] = int(r["x"])
    n, inertia, scanned = [0] * k, [0] * k, 0
    for r in rows.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("inertia").alias("inertia"), F.sum("scanned").alias("scanned")).collect():
        n[r["cluster"]], inertia[r["cluster"]] = r["n"], int(r["inertia"])
        scanned += r["scanned"]
    return n, inertia, sums, scanned


def cluster(df: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, log: list | None = None) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of
    every kept vector.  ``log`` receives the vectors scanned in each pass."""
    spark = df.sparkSession
    fields = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    vectors = kept_vectors(df, dims)
    centroids = first_centroids(vectors, k, scale)
    if not len(centroids):
        return spark.createDataFrame([], fields)
    old, state, folder = None, None, None
    for step in range(rounds + 1):
        following = start(vectors, centroids, scale) if state is None else next_round(state, old, centroids)
        path = shared_dir(spark, f"clusters-{step}")
        following.write.parquet(path)
        if folder:
            remove_folder(spark, folder)
        state, folder = spark.read.schema(following.schema).parquet(path), path
        n, inertia, sums, scanned = cluster_sums(state, len(centroids), dims)
        if log is not None:
            log.append(scanned)
        if step < rounds:
            moved = [[x // n[i] for x in sums[i]] if n[i] else centroids[i].tolist() for i in range(len(centroids))]
            old, centroids = centroids, np.array(moved, np.int64)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    total = sum(inertia)

    def rows(batches):
        for b in batches:
            for r in b.to_pylist():
                ids, nulls, _, own, distance, _ = _unpack(r, dims)
                at = own.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64(), mask=nulls), pa.array(own, pa.int32()), pa.array(distance), pa.array([inertia[i] for i in at], pa.int64()),
                     pa.array([total] * len(at), pa.int64()), pa.array([digest[i] for i in at])], names=[f.split()[0] for f in fields.split(", ")])

    return state.where("cluster is null").select(*[f.split()[0] for f in _STATE.split(", ")]).mapInArrow(rows, fields)


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    parts = [f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIMS} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {DIMS}
), c0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS w FROM (
    SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h, v LIMIT {K})
)"""]
    for i in range(ROUNDS + 1):
        parts.append(f"""a{i} AS (
  SELECT vec_id, v, c, d FROM (
    SELECT vec_id, v, c, list_sum(list_transform(range(1, {DIMS + 1}), lambda i: (v[i] - w[i]) * (v[i] - w[i]))) AS d FROM kept CROSS JOIN c{i})
  QUALIFY row_number() OVER (PARTITION BY vec_id, v ORDER BY d, c) = 1
)""")
        if i < ROUNDS:
            parts.append(f"""c{i + 1} AS (
  SELECT c, coalesce(m.w, o.w) AS w FROM c{i} o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS w
    FROM (SELECT c, p, sum(v[p]) AS s, count(*) AS n FROM (SELECT c, v, unnest(range(1, {DIMS + 1})) AS p FROM a{i}) GROUP BY c, p) GROUP BY c) m USING (c)
)""")
    return ", ".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} USING (c)
"""


#: holds for tables without repeated rows
ORACLE = _oracle()
