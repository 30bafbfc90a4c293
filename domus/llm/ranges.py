"""Documents dealt to partitions by ranges of doc_id.

Bounds are approximate doc_id quantiles, so a part has about ``part_bytes`` of
text; the number of parts follows the size of the table.  A doc_id that stands
on several bounds (many rows share it) is spread over their parts by the hash
of its text, in the order of that hash, so parts stay ordered by (doc_id, hash).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART_BYTES = 8 << 20
NULL_KEY = np.iinfo(np.int64).min  # null doc_ids come first


@dataclass
class Ranges:
    bounds: np.ndarray  # a part ends with its bound
    n_docs: int
    n_bytes: int

    @property
    def parts(self) -> int:
        return len(self.bounds) + 1

    def part_of(self, key: np.ndarray, h: np.ndarray) -> np.ndarray:
        left = np.searchsorted(self.bounds, key, side="left")
        shared = np.searchsorted(self.bounds, key, side="right") - left
        share = h.astype(np.float64) / 2.0 ** 64 + 0.5  # the signed hash's place among all
        return left + np.minimum((share * shared).astype(np.int64), np.maximum(shared - 1, 0))


def id_hash_text(docs: DataFrame) -> DataFrame:
    """doc_id, key (doc_id, nulls first), h (hash of the text) and text."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.select("doc_id", F.coalesce("doc_id", F.lit(NULL_KEY)).alias("key"), F.xxhash64("text").alias("h"), "text")


def text_ranges(docs: DataFrame, part_bytes: int = PART_BYTES, least: int | None = None) -> Ranges:
    """Bounds from one pass for the size and one over the ids alone."""
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col("text").cast("string")).cast("long")).alias("bytes")).first()
    n_bytes = int(size["bytes"] or 0)
    parts = max(least or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // part_bytes))
    bounds = []
    if parts > 1:
        cuts = [i / parts for i in range(1, parts)]
        key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY))
        bounds = docs.agg(F.percentile_approx(key, cuts, max(10_000, 20 * parts)).alias("q")).first()["q"] or []
    return Ranges(np.array(sorted(bounds), np.int64), int(size["n"]), n_bytes)
