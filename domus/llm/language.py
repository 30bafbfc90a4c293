"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors of hashed byte 2- and 3-grams (letters
lower-cased, other ASCII characters as one blank).  Document frequencies come
from every learning document.  For each language, spherical k-means over a
sample of ``SAMPLE_PER_LANG`` labelled documents (those with the smallest hashes
of doc_id and text; all where there are fewer) gives ``CLUSTERS`` centroids; a text gets the language of the
centroid with the highest cosine.  The distance of the sample to its own
language's centroids, by bands of text length, sets the rejection limit: a
text farther away than ``SLACK`` times the largest such distance is rejected
(its language is still reported).

``lang_pred`` is ``und`` and the score 0 for null texts and texts without a
letter; these are rejected.  With no learning document every text is ``und``.
Repeated rows and doc_ids each give a row; null labels are not learnt from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from domus.llm.common import slices, table

DIMS = 1 << 13
SAMPLE_PER_LANG = 1000
CLUSTERS = 3
ROUNDS = 8
BANDS = 8  # text length bands: below 16, 32, 64 ... bytes
SLACK = 1.15
SLICE_ROWS = 128  # rows of a dense count matrix (DIMS wide), however short the texts

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:0x80] = 0x20
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def gram_counts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Documents x DIMS counts of the hashed n-grams of a slice."""
    n = len(offs) - 1
    if len(data) == 0:
        return np.zeros((n, DIMS), np.float32)
    b = _FOLD[data]
    doc = np.repeat(np.arange(n, dtype=np.int64) * DIMS, np.diff(offs))
    blank = np.full(2, 0x20, np.uint32)
    nxt = np.concatenate([b, blank])
    last = offs[1:] - 1
    last = last[np.diff(offs) > 0]
    two = nxt[1:len(b) + 1].copy()
    two[last] = 0x20  # a document ends in a blank
    three = np.concatenate([two[1:], blank[:1]])
    three[last] = 0x20
    bi = ((b * np.uint32(257) + two) * np.uint32(0x9E3779B1)) >> np.uint32(32 - 13)
    tri = (((b * np.uint32(257) + two) * np.uint32(263) + three) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 13)
    counts = np.bincount(doc + bi, minlength=n * DIMS) + np.bincount(doc + tri, minlength=n * DIMS)
    return counts.reshape(n, DIMS).astype(np.float32)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts) * idf
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    norm[norm == 0] = 1
    return x / norm[:, None]


def band(n_bytes: np.ndarray) -> np.ndarray:
    return np.clip(np.log2(np.maximum(n_bytes, 1)).astype(np.int64) - 3, 0, BANDS - 1)


def learning_rows(docs: DataFrame) -> DataFrame:
    """Labelled documents outside the held-out quarter."""
    return docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}"))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def document_frequencies(docs: DataFrame) -> tuple:
    """(number of documents, documents holding each feature), over all of them."""
    def run(batches):
        total, n = np.zeros(DIMS, np.int64), 0
        for b in batches:
            for _, k, data, offs in slices(b, "text", rows=SLICE_ROWS):
                total += (gram_counts(data, offs) > 0).sum(axis=0)
                n += k
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMS), pa.int32()), pa.array(np.r_[n, total])], names=["f", "n"])

    rows = docs.select("text").mapInArrow(run, "f int, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(DIMS, np.int64)
    n = 0
    for r in rows:
        if r["f"] < 0:
            n = r["n"]
        else:
            df[r["f"]] = r["n"]
    return n, df


def hash_limit(count: int, bound: int, least: int) -> int:
    """Largest 64-bit hash that about 2 * ``bound`` of ``count`` rows do not exceed, and at least one row (hash ``least``) does not."""
    return max(least, -(1 << 63) + (min(count, 2 * bound) << 64) // count - 1)


def _sample(learn: DataFrame, bound: int) -> DataFrame:
    """The ``bound`` rows of each language with the smallest hashes, or all its rows if it has fewer.  A limit from the
    language's count leaves about twice as many rows to be ranked."""
    h = F.xxhash64("doc_id", "text", F.lit("sample"))
    counts = learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(h).alias("least")).collect()
    if not counts:
        return learn.select("lang", "text", F.lit(0).alias("h")).limit(0)
    limit = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(hash_limit(r["n"], bound, r["least"])).cast("long"))])
    near = learn.select("lang", "text", h.alias("h")).filter(F.col("h") <= F.element_at(limit, F.col("lang")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= bound).drop("_rank")


def spherical_kmeans(x: np.ndarray, k: int) -> np.ndarray:
    """Centroids of unit rows, started at the rows farthest from those chosen so far."""
    c = x.mean(axis=0, keepdims=True)
    centres = [x[int(np.argmax(x @ c[0]))]]
    while len(centres) < min(k, len(x)):
        centres.append(x[int(np.argmin(np.max(x @ np.stack(centres).T, axis=1)))])
    centres = np.stack(centres)
    for _ in range(ROUNDS):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.stack([x[own == j].sum(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def fit(docs: DataFrame, sample: int = SAMPLE_PER_LANG, clusters: int = CLUSTERS) -> dict:
    """The model: languages, idf, centroids and the rejection limits by length band."""
    learn = learning_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                      F.col("lang").cast("string").alias("lang")))
    n, df = document_frequencies(learn)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    def centroids(key, rows):
        rows = rows.sort_by([("h", "ascending"), ("text", "ascending")]).combine_chunks()
        parts, sizes = [], []
        for b in rows.to_batches():
            for _, _, data, offs in slices(b, "text", rows=SLICE_ROWS):
                parts.append(vectors(gram_counts(data, offs), idf))
                sizes.append(np.diff(offs))
        x, size = np.concatenate(parts), np.concatenate(sizes)
        c = spherical_kmeans(x, clusters).astype(np.float32)
        far = 1 - (x @ c.T).max(axis=1)
        limit = np.full(BANDS, np.nan)
        for j in range(BANDS):
            if (band(size) == j).any():
                limit[j] = far[band(size) == j].max()
        return pa.table({"lang": [key[0].as_py()] * len(c), "centre": [r.astype("<f4").tobytes() for r in c], "far": [limit.tolist()] * len(c)})

    got = _sample(learn, sample).groupBy("lang").applyInArrow(centroids, "lang string, centre binary, far array<double>").collect()
    got.sort(key=lambda r: (r["lang"], r["centre"]))
    limits: dict = {}
    for r in got:
        limits[r["lang"]] = np.array([np.nan if v is None else v for v in r["far"]])
    worst = np.full(BANDS, np.nan)
    for v in limits.values():
        worst = np.fmax(worst, v)
    # a shorter band is never stricter than a longer one, and a band without a sample takes its neighbour's limit
    for j in range(BANDS - 2, -1, -1):
        worst[j] = np.fmax(worst[j], worst[j + 1])
    worst = np.where(np.isnan(worst), np.nanmin(worst) if len(got) else 2.0, worst)
    return {"langs": [r["lang"] for r in got], "idf": idf, "limits": np.minimum(worst * SLACK, 1.0),
            "centres": np.stack([np.frombuffer(r["centre"], "<f4") for r in got]) if got else np.zeros((0, DIMS), np.float32)}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with lang_pred, score and rejected added (own columns of those names give way)."""
    keep = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    docs = docs.select(*keep).withColumn("text", F.col("text").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        langs = np.array([*m["langs"], "und"], dtype=object)
        for b in batches:
            pred = np.full(b.num_rows, len(langs) - 1)
            score = np.zeros(b.num_rows)
            rejected = np.ones(b.num_rows, bool)
            lettered = np.array(b.column(b.num_columns - 1).to_pylist(), bool)
            if len(langs) > 1:
                for i, n, data, offs in slices(b, "text", rows=SLICE_ROWS):
                    s = vectors(gram_counts(data, offs), m["idf"]) @ m["centres"].T
                    best = s.argmax(axis=1)
                    top = np.clip(s[np.arange(n), best].astype(float), 0, 1)
                    ok = lettered[i:i + n]
                    pred[i:i + n] = np.where(ok, best, len(langs) - 1)
                    score[i:i + n] = np.where(ok, top, 0)
                    rejected[i:i + n] = ~ok | (1 - top > m["limits"][band(np.diff(offs))])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(langs[pred].tolist(), pa.string()), pa.array(score), pa.array(rejected)],
                names=[*b.schema.names[:-1], "lang_pred", "score", "rejected"])

    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    out = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                      StructField("rejected", BooleanType())])
    return docs.withColumn("_lettered", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).mapInArrow(run, out)


def accepted(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that are not rejected."""
    packed = docs.select(F.struct(*docs.columns).alias("whole"), "text")
    return predict(packed, model).filter(~F.col("rejected")).select("whole.*")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = predict(docs.select("doc_id", "text"), fit(docs))
    return got.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "lang_pred", "score", "rejected")


