"""Helpers shared by the operators: Arrow batch slicing, word spans over UTF-8
bytes and 64/128-bit span hashes, all vectorised over a slice of documents."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20  # text bytes handled by one numpy pass (a longer document is one pass)


def give_back() -> None:
    """Return freed memory to the system: worker processes live on between
    groups and tasks, and what one keeps the next ones lack."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id as long and text, whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder's path for files that all executors must see, below the
    checkpoint folder the cluster names (a temp folder where it names none,
    as in local tests)."""
    import os
    import tempfile
    import uuid

    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "domus-llm")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, and a lost executor re-reads instead of recomputing."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that ``shared_dir`` named and nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES, rows: int | None = None):
    """Yield (first row, row count, bytes, offsets) of consecutive rows whose
    text takes about ``limit`` bytes, ``rows`` rows at most if given; null
    counts as empty."""
    col = batch.column(column)
    arr = col.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    n = len(arr)
    if n == 0:
        return
    offs = np.frombuffer(arr.buffers()[1], dtype=np.int64, count=n + 1, offset=8 * arr.offset)
    data = np.frombuffer(arr.buffers()[2], dtype=np.uint8) if arr.buffers()[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n if rows is None else min(n, i + rows))
        yield i, j - i, data[offs[i]:offs[j]], (offs[i:j + 1] - offs[i])
        i = j


def byte_class(separators: bytes) -> np.ndarray:
    lut = np.ones(256, dtype=bool)
    lut[list(separators)] = False
    return lut


#: words are runs of anything but ASCII white space
SPACE_WORDS = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
#: words are runs of ASCII digits, lower-case letters and all non-ASCII bytes
ALNUM_WORDS = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: maps A-Z to a-z
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_spans(data: np.ndarray, offs: np.ndarray, lut: np.ndarray):
    """Starts and ends (byte positions) of the words of all documents of a
    slice, and the word offset of every document (length documents + 1)."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    w = lut[data]
    edge = np.empty(len(w), bool)
    edge[0] = True
    np.logical_not(w[:-1], out=edge[1:])
    inner = offs[(offs > 0) & (offs < len(data))]
    edge[inner] = True
    starts = np.flatnonzero(w & edge)
    edge[-1] = True
    np.logical_not(w[1:], out=edge[:-1])
    edge[inner - 1] = True
    ends = np.flatnonzero(w & edge) + 1
    return starts, ends, np.searchsorted(starts, offs).astype(np.int64)


def mix64(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_MULT = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


@functools.lru_cache(maxsize=4)
def _byte_values(which: int) -> np.ndarray:
    return mix64((np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * which)) * np.uint64(_MULT[1 - which]))


_POWERS: dict = {}


def _powers(which: int, n: int):
    """Powers of an odd multiplier and of its inverse modulo 2**64."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        p = np.full(size, _MULT[which], np.uint64)
        q = np.full(size, pow(_MULT[which], -1, 1 << 64), np.uint64)
        p[0] = q[0] = 1
        have = (np.cumprod(p, dtype=np.uint64), np.cumprod(q, dtype=np.uint64))
        _POWERS.clear() if n > (1 << 23) else None
        _POWERS[which] = have
    return have


def _span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for every span, from one prefix sum."""
    n = len(values)
    p, q = _powers(which, n + 1)
    c = np.zeros(n + 1, np.uint64)
    np.cumsum(values * p[:n], out=c[1:])
    return (c[ends] - c[starts]) * q[starts]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    h = _span_sums(_byte_values(which)[data], starts, ends, which)
    return mix64(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))


def gram_hashes(words: np.ndarray, first: np.ndarray, last: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of the word sequences words[first:last] (by index arrays)."""
    if len(first) == 0:
        return np.zeros(0, np.uint64)
    h = _span_sums(words, first, last, which)
    return mix64(h ^ ((last - first).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)))


def within_ranges(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of range(first, first + count)."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    at = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(firsts - at, counts)


def as_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
