"""Documents in blocks, and fingerprints of blocks in buckets.

Operators that look for repeated passages work on blocks of documents (about
``BLOCK_BYTES`` of text, compressed, one shuffle by block) and send packed,
sorted fingerprints of a block to buckets (by fingerprint).  A bucket answers
every block with one value per fingerprint sent.  So a fingerprint reaches its
bucket once per block however often the block repeats it, rows in the shuffle
are few and long, and no task holds more than a block or a bucket; the number
of buckets follows the size of the text.

A block is named by the hash of its rows, so a recomputed block has its old
name; equal blocks are one block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus.llm.common import give_back, id_and_text, slices

BLOCK_BYTES = 4 << 20
BUCKET_TEXT_BYTES = 16 << 20  # text bytes whose fingerprints share a bucket
NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id: no smaller document


def compress(x: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(x)


def decompress(x: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(x)


def text_blocks(docs: DataFrame, limit: int | None = None) -> DataFrame:
    """(block, ids, offsets, payload): documents packed in blocks of about
    ``limit`` bytes (``BLOCK_BYTES`` if not given)."""
    limit = limit or BLOCK_BYTES

    def run(batches):
        ids, parts, lens, size = [], [], [], 0

        def cut():
            raw = b"".join(parts)
            own, offs = np.array(ids, np.int64).tobytes(), np.concatenate([[0], np.cumsum(lens)]).astype(np.int64).tobytes()
            h = hashlib.blake2b(own, digest_size=12)
            h.update(offs)
            h.update(raw)
            return pa.RecordBatch.from_arrays([pa.array([h.hexdigest()]), pa.array([own], pa.binary()), pa.array([offs], pa.binary()),
                                               pa.array([compress(raw)], pa.binary())], names=["block", "ids", "offsets", "payload"])

        for b in batches:
            own = b.column("doc_id").fill_null(NO_ID).to_pylist()
            for i, n, data, offs in slices(b, "text", min(limit, 1 << 18)):
                ids += own[i:i + n]
                parts.append(data.tobytes())
                lens += np.diff(offs).tolist()
                size += len(data) + 16 * n
                if size >= limit:
                    yield cut()
                    ids, parts, lens, size = [], [], [], 0
        if ids:
            yield cut()

    return id_and_text(docs).mapInArrow(run, "block string, ids binary, offsets binary, payload binary")


def unpack(rows: pa.Table):
    """doc_ids, bytes and offsets of a block."""
    give_back()  # of the block before
    ids, datas, offs, at = [], [], [np.zeros(1, np.int64)], 0
    for r in rows.sort_by([("ids", "ascending"), ("offsets", "ascending")]).to_pylist():
        ids.append(np.frombuffer(r["ids"], np.int64))
        raw = decompress(r["payload"])
        datas.append(np.frombuffer(raw, np.uint8))
        offs.append(np.frombuffer(r["offsets"], np.int64)[1:] + at)
        at += len(raw)
    return np.concatenate(ids), np.concatenate(datas), np.concatenate(offs)


def sub_slices(data: np.ndarray, offs: np.ndarray, limit: int = 1 << 20):
    """Yield (first document, bytes, offsets) of stretches of documents."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = min(max(int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1, i + 1), n)
        yield i, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def bucket_count(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")).cast("long"))).first()[0] or 0
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(4 * parts, -(-int(size) // BUCKET_TEXT_BYTES))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def by_bucket(buckets: np.ndarray):
    """Yield (bucket, lo, hi) of runs of a sorted bucket array."""
    if len(buckets) == 0:
        return
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(buckets)) + 1, [len(buckets)]])
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield int(buckets[lo]), lo, hi


SENT = "bucket int, block string, blob binary"
ANSWER = "block string, bucket int, stage int, bits binary"


def sent(block: str, rows: list) -> pa.Table:
    """Rows of SENT from (bucket, blob) pairs."""
    return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([block] * len(rows), pa.string()),
                     "blob": pa.array([r[1] for r in rows], pa.binary())})


def answers(rows: pa.Table, stage: int, bits: list) -> pa.Table:
    return pa.table({"block": rows.column("block"), "bucket": rows.column("bucket"), "stage": pa.array([stage] * len(rows), pa.int32()),
                     "bits": pa.array(bits, pa.binary())})


def read_bits(answer: pa.Table, stage: int, sizes: list) -> np.ndarray:
    """The flags of a block in the order its fingerprints were sent: ``sizes``
    has (bucket, count) in that order."""
    have = {r["bucket"]: r["bits"] for r in answer.to_pylist() if r["stage"] == stage}
    out = []
    for bucket, n in sizes:
        out.append(np.unpackbits(np.frombuffer(have[bucket], np.uint8), count=n).astype(bool))
    return np.concatenate(out) if out else np.zeros(0, bool)


def shared_flags(rows: pa.Table, stage: int) -> pa.Table:
    """Answers, for blobs of (count, sorted distinct uint64, flag per value):
    whether the value is flagged or stands in two blocks."""
    parts, flags, sizes = [], [], []
    for b in rows.column("blob").to_pylist():
        n = len(b) // 9
        parts.append(np.frombuffer(b, np.uint64, n))
        flags.append(np.frombuffer(b, np.uint8, n, 8 * n))
        sizes.append(n)
    h, f = np.concatenate(parts), np.concatenate(flags)
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.concatenate([[True], s[1:] != s[:-1]])
    group = np.cumsum(first) - 1
    start = np.flatnonzero(first)
    many = (np.diff(np.concatenate([start, [len(s)]])) > 1) | (np.maximum.reduceat(f[order], start) > 0)
    out = np.empty(len(h), bool)
    out[order] = many[group]
    cuts = np.cumsum(sizes)[:-1]
    return answers(rows, stage, [np.packbits(x).tobytes() for x in np.split(out, cuts)])


def distinct_with_flag(h: np.ndarray, doc: np.ndarray | None):
    """Distinct values ordered by (value), and whether each stands in two
    documents (with ``doc`` None: stands twice)."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
    start = np.flatnonzero(first)
    if not len(start):
        return s, np.zeros(0, np.uint8)
    if doc is None:
        many = np.diff(np.concatenate([start, [len(s)]])) > 1
    else:
        d = doc[order]
        many = np.minimum.reduceat(d, start) != np.maximum.reduceat(d, start)
    return s[first], many.astype(np.uint8)


def send_distinct(h: np.ndarray, flag: np.ndarray, buckets: int):
    """(rows to send, sizes, order): distinct values by bucket; ``order`` puts
    the values into the order sent."""
    b = bucket_of(h, buckets)
    order = np.argsort(b, kind="stable")
    hs, fs = h[order], flag[order]
    rows, sizes = [], []
    for bucket, lo, hi in by_bucket(b[order]):
        rows.append((bucket, hs[lo:hi].tobytes() + fs[lo:hi].tobytes()))
        sizes.append((bucket, hi - lo))
    return rows, sizes, order
