"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the benchmark's windows of ``WINDOW`` words (an item with fewer
words is one pattern).  Patterns of one length m form a group.  For the group,
a shift table maps the hash of a block of ``BLOCK`` words to the distance the
search may skip when that block ends at the cursor: m - BLOCK + 1 where no
pattern holds the block, else its smallest distance to a pattern's end.  At a
shift of 0 the block's bucket lists the patterns that end with it; each is
compared word for word.  Many cursors, one per stretch of words, move in step.

A Spark job makes the distinct windows of the benchmark with the items that
hold them and writes them; the search takes them in blocks (by hash) of at most
about ``ITEM_BLOCK_CHARS`` characters of windows.  With more than one block, each
is a pass over the documents whose result is written before the next block's
tables are built, and word hits are united per document.
Null texts have no words; items or documents without words match nothing;
repeated items and documents each count as they stand (equal item_ids once).  An
item whose item_id is null is searched for like any other, but has no name to be
counted or listed by.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm.common import ALNUM_WORDS, LOWER, gram_hashes, id_and_text, materialise, slices, table, within_ranges, word_hashes, word_spans

WINDOW = 10
BLOCK = 2
STRETCH = 1024  # words a cursor covers
ITEM_BLOCK_CHARS = 32 << 20  # characters of windows compiled and broadcast at a time


def split_words(text: str | None) -> list:
    """The words of a text as bytes (lower-cased A-Z, ASCII alphanumerics and all other characters)."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    low = LOWER[data]
    s, e, _ = word_spans(low, np.array([0, len(low)], np.int64), ALNUM_WORDS)
    raw = low.tobytes()
    return [raw[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)]


def _hash_words(words: list) -> np.ndarray:
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    return word_hashes(data, ends - np.array([len(w) for w in words], np.int64), ends)


class WordGroup:
    """Shift table and buckets of the patterns of one length."""

    def __init__(self, length: int, patterns: dict):
        """patterns: tuple of words -> names of the items that hold it."""
        self.length = length
        self.block = b = min(BLOCK, length)
        self.words = list(patterns)
        self.items = list(patterns.values())
        flat = _hash_words([w for p in self.words for w in p]).reshape(-1, length)
        at = np.arange(len(self.words) * length).reshape(-1, length)
        blocks = [gram_hashes(flat.ravel(), at[:, j], at[:, j] + b) for j in range(length - b + 1)]
        keys = np.concatenate(blocks)
        dist = np.repeat(np.arange(length - b, -1, -1), len(self.words))
        self.mask = np.uint64((1 << max(16, int(8 * len(keys) + 1).bit_length())) - 1)
        self.shifts = np.full(int(self.mask) + 1, length - b + 1, np.int32)
        np.minimum.at(self.shifts, (keys & self.mask).astype(np.int64), dist.astype(np.int32))
        last = blocks[-1]
        by = np.argsort(last, kind="stable")
        self.ends, self.bucket = last[by], by
        self.flat = flat

    def search(self, hashes: np.ndarray, doc_words: np.ndarray):
        """Yield (word index, pattern number) of candidate occurrences whose words hash alike."""
        m, b = self.length, self.block
        # cursors stand on the last word of a possible occurrence
        lows, highs = doc_words[:-1] + m - 1, doc_words[1:]
        n = np.maximum(0, -(-(highs - lows) // STRETCH))
        start = np.repeat(lows, n) + STRETCH * (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))
        stop = np.minimum(start + STRETCH, np.repeat(highs, n))
        cur = start
        found = []
        first = np.arange(max(0, len(hashes) - b + 1))
        blocks = gram_hashes(hashes, first, first + b)  # by the block's first word
        skip = self.shifts[(blocks & self.mask).astype(np.int64)]
        while len(cur):
            shift = skip[cur - b + 1]
            hit = shift == 0
            if hit.any():
                at, hh = cur[hit], blocks[cur[hit] - b + 1]
                lo, hi = np.searchsorted(self.ends, hh, "left"), np.searchsorted(self.ends, hh, "right")
                pos = np.repeat(at, hi - lo) - m + 1
                pat = self.bucket[within_ranges(lo, hi - lo)]
                same = np.ones(len(pos), bool)
                for j in range(m):
                    same &= hashes[pos + j] == self.flat[pat, j]
                found.append((pos[same], pat[same]))
            cur = cur + np.maximum(shift, 1)
            keep = cur < stop
            cur, stop = cur[keep], stop[keep]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(length, words, items): the distinct windows, words joined by a space,
    and the names of the items that hold them."""
    def run(batches):
        for b in batches:
            for item, text in zip(b.column("item").to_pylist(), b.column("text").to_pylist(), strict=True):
                words = split_words(text)
                m = min(WINDOW, len(words))
                own = sorted({b" ".join(words[at:at + m]) for at in range(len(words) - m + 1 if m else 0)})
                if own:
                    yield pa.RecordBatch.from_arrays([pa.array([m] * len(own), pa.int32()), pa.array(own, pa.binary()), pa.array([item] * len(own), pa.string())],
                                                     names=["length", "words", "item"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    windows = items.mapInArrow(run, "length int, words binary, item string")
    return windows.groupBy("length", "words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def window_blocks(benchmark: DataFrame):
    """(number of blocks, function that compiles block k into word groups)."""
    windows = materialise(item_windows(benchmark), "benchmark-windows")
    size = windows.agg(F.sum(F.octet_length("words").cast("long"))).first()[0] or 0
    n = -(-int(size) // ITEM_BLOCK_CHARS) or 1

    def block(k: int) -> list:
        part = windows if n == 1 else windows.where(F.pmod(F.xxhash64("words"), F.lit(n)) == k)
        by_length: dict = {}
        for r in part.collect():  # one block
            by_length.setdefault(r["length"], {})[tuple(bytes(r["words"]).split(b" "))] = list(r["items"])
        return [WordGroup(m, pats) for m, pats in sorted(by_length.items())]

    return n, block


def _occurrences(groups: list, data: np.ndarray, offs: np.ndarray):
    """Yield (document, first word, one past the last, item names) of every
    occurrence in a slice, compared word for word."""
    low = LOWER[data]
    s, e, doc_words = word_spans(low, offs, ALNUM_WORDS)
    hashes = word_hashes(low, s, e)
    raw = low.tobytes()
    for g in groups:
        pos, pat = g.search(hashes, doc_words) if len(hashes) else ([], [])
        if not len(pos):
            continue
        doc = np.searchsorted(doc_words, pos, side="right") - 1
        for p, q, d in zip(pos.tolist(), pat.tolist(), doc.tolist(), strict=True):
            if all(raw[x:y] == w for x, y, w in zip(s[p:p + g.length].tolist(), e[p:p + g.length].tolist(), g.words[q], strict=True)):
                first = p - int(doc_words[d])
                yield d, first, first + g.length, g.items[q]


def find_hits(docs: DataFrame, model) -> DataFrame:
    """doc_id, n_words, hits (array of start, end word runs), item_ids
    (array<string>); ``model`` is the broadcast of a block's word groups."""
    run_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def run(batches):
        groups = model.value
        for b in batches:
            own = b.column("doc_id")
            for i, n, data, offs in slices(b, "text"):
                spans: list = [[] for _ in range(n)]
                seen: list = [set() for _ in range(n)]
                doc_words = word_spans(LOWER[data], offs, ALNUM_WORDS)[2]
                for d, first, last, own_items in _occurrences(groups, data, offs):
                    spans[d].append((first, last))
                    seen[d].update(own_items)
                yield pa.RecordBatch.from_arrays(
                    [own.slice(i, n), pa.array(np.diff(doc_words)),
                     pa.array([[{"first": x, "last": y} for x, y in merge(v)] for v in spans], run_type),
                     pa.array([sorted(v) for v in seen], pa.list_(pa.string()))],
                    names=["doc_id", "n_words", "hits", "item_ids"])

    return docs.mapInArrow(run, "doc_id long, n_words long, hits array<struct<first:long,last:long>>, item_ids array<string>")


def merge(spans: list) -> list:
    out: list = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, hits, item_ids, contaminated."""
    rows, spark = id_and_text(docs), docs.sparkSession
    n, block = window_blocks(benchmark)
    if n == 1:
        hits = find_hits(rows, spark.sparkContext.broadcast(block(0)))
    else:
        # every pass gives a row the same number, which keeps repeated doc_ids apart
        parts = []
        for k in range(n):
            model = spark.sparkContext.broadcast(block(k))
            parts.append(materialise(find_hits(rows, model).withColumn("row", F.monotonically_increasing_id()), "hits"))
            model.unpersist()
        both = parts[0]
        for p in parts[1:]:
            both = both.unionByName(p)
        gathered = both.groupBy("row", "doc_id", "n_words").agg(
            F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
        hits = gathered.drop("row").withColumn("hits", _merged("hits"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda t, x: t + x["last"] - x["first"])
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), "hits", "item_ids",
                       (n_hit > 0).alias("contaminated"))


def _merged(name: str):
    """Union of sorted runs, in the JVM."""
    empty = F.array().cast("array<struct<first:bigint,last:bigint>>")

    def step(out, x):
        last = F.try_element_at(out, F.lit(-1))
        joined = F.struct(last["first"].alias("first"), F.greatest(last["last"], x["last"]).alias("last"))
        return F.when((F.size(out) > 0) & (x["first"] <= last["last"]),
                      F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(out, F.array(x)))

    return F.aggregate(F.array_sort(F.col(name)), empty, step)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text holds no pattern."""
    n, block = window_blocks(benchmark)
    kept = docs
    for k in range(n):
        model = docs.sparkSession.sparkContext.broadcast(block(k))
        kept = _without_hits(kept, model)
        if n > 1:
            kept = materialise(kept, "clean")
            model.unpersist()
    return kept


def _without_hits(docs: DataFrame, model) -> DataFrame:
    def run(batches):
        groups = model.value
        for b in batches:
            hit = np.zeros(b.num_rows, bool)
            for i, _, data, offs in slices(b, "text"):
                for found in _occurrences(groups, data, offs):
                    hit[i + found[0]] = True
            yield b.filter(pa.array(~hit))

    return docs.mapInArrow(run, docs.schema)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")
