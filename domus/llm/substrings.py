"""Substring dedup by seed and extend over words.

Seeds are winnowed anchors: of every window of ``WINDOW`` words, the word
sequence of ``GRAM`` words with the smallest hash (the leftmost of equals).
Equal windows have equal anchors at equal offsets, so every repeated window is
found from an anchor that two documents share.  Documents are joined on the
shared anchors: each occurrence sends its context, the words of the windows it
stands for, to the anchor's bucket (each distinct context of a block once, with
the smallest doc_id that has it).  There the contexts are extended word by word
to the right and to the left: contexts that agree so far stay in one class.  A
window that starts j words before the anchor matches where j words to the left
and the rest to the right agree; it is a repeat where a smaller doc_id has it,
and the overlapping repeats of a document join into maximal ones.

An anchor that may have more than ``HOT_CONTEXTS`` contexts over all blocks (a
common phrase in many surroundings) is not joined in one task: its windows meet
by their 128-bit hashes in buckets of their own, with the same result.

A document keeps the words outside its repeats.  Null texts have no words; null
doc_ids count as larger than any other; rows that repeat a doc_id are one
document with respect to each other (none of them is the smaller) and each
gives a row.  Texts below WINDOW words keep all words.
"""

from __future__ import annotations

from itertools import compress as pick

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm import blocks as B
from domus.llm.common import SPACE_WORDS, gram_hashes, table, within_ranges, word_hashes, word_spans

WINDOW = 13
GRAM = 5
HOT_CONTEXTS = 4096  # contexts of one anchor, over all blocks, that are compared in one task
WINDOW_BUCKETS = 4   # buckets of window hashes for each bucket of anchors


def block_words(data: np.ndarray, offs: np.ndarray):
    """Word hashes (two of them) and the word offset of every document of a block."""
    h1, h2, counts = [], [], []
    for _, part, o in B.sub_slices(data, offs):
        s, e, dw = word_spans(part, o, SPACE_WORDS)
        h1.append(word_hashes(part, s, e, 0))
        h2.append(word_hashes(part, s, e, 1))
        counts.append(np.diff(dw))
    if not counts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate(h1), np.concatenate(h2), np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)


def window_anchors(h: np.ndarray, doc_words: np.ndarray, window: int, gram: int) -> tuple:
    """(anchor position, hash, first window start, last window start, document)
    of every anchor occurrence, in order."""
    n = np.maximum(0, np.diff(doc_words) - window + 1)
    doc = np.repeat(np.arange(len(n)), n)
    start = within_ranges(doc_words[:-1], n)
    at = np.arange(max(0, len(h) - gram + 1))
    g = gram_hashes(h, at, at + gram)
    best, off = g[start], np.zeros(len(start), np.int64)
    for t in range(1, window - gram + 1):
        other = g[start + t]
        less = other < best
        best[less], off[less] = other[less], t
    pos = start + off
    new = changes(pos, doc)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return pos[first], best[first], start[first], start[last] if len(first) else start[:0], doc[first]


def changes(*cols: np.ndarray) -> np.ndarray:
    """Where a row of columns differs from the one before (the first does)."""
    out = np.zeros(len(cols[0]), bool)
    out[:1] = True
    for c in cols:
        out[1:] |= c[1:] != c[:-1]
    return out


class _Windows:
    """What a block's passes compute alike.  An entry is a distinct (anchor,
    offset of the anchor, context) of the block, with its smallest doc_id."""

    def __init__(self, rows: pa.Table, buckets: int, window: int, gram: int):
        self.ids, self.data, self.offs = B.unpack(rows)
        self.h1, self.h2, self.doc_words = block_words(self.data, self.offs)
        self.window, self.buckets = window, buckets
        pos, anchor, self.first, self.last, self.doc = window_anchors(self.h1, self.doc_words, window, gram)
        left, n, own = pos - self.first, self.last - self.first + 1, self.ids[self.doc]
        x, y = (gram_hashes(h, self.first, self.last + window, k) for k, h in enumerate((self.h1, self.h2)))
        order = np.lexsort((own, y, x, n, left, anchor))
        h = anchor[order]
        top, new = changes(h), changes(h, left[order], n[order], x[order], y[order])
        self.entry = np.empty(len(h), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        some = order[at]  # the occurrence of every entry with the smallest doc_id
        self.anchor = (np.cumsum(top) - 1)[at]
        self.begin, self.left, self.n, self.least = self.first[some], left[some], n[some], own[some]
        self.distinct = h[top]
        # whether two documents have it, and the logarithm of the number of its contexts
        groups = np.flatnonzero(top)
        kinds = np.bincount(self.anchor, minlength=len(groups))
        ids = own[order]
        two = np.minimum.reduceat(ids, groups) != np.maximum.reduceat(ids, groups) if len(groups) else np.zeros(0, bool)
        flag = (2 * np.ceil(np.log2(np.maximum(kinds, 1))) + two).astype(np.uint8)
        self.rows, self.sizes, self.order = B.send_distinct(self.distinct, flag, buckets)

    def seeded(self, answer: pa.Table) -> None:
        """Entries of anchors that two documents share, by bucket; of hot anchors the distinct windows."""
        flags = np.zeros((2, len(self.distinct)), bool)
        for row, stage in zip(flags, (1, 3), strict=True):
            row[self.order] = B.read_bits(answer, stage, self.sizes)
        shared, hot = flags[0][self.anchor], flags[1][self.anchor]
        keep = np.flatnonzero(shared & ~hot)
        bucket = B.bucket_of(self.distinct[self.anchor[keep]], self.buckets)
        order = np.argsort(bucket, kind="stable")
        self.keep, self.bucket = keep[order], bucket[order]
        own = np.flatnonzero((shared & hot)[self.entry]) if len(self.entry) else np.zeros(0, np.int64)
        count = self.last[own] - self.first[own] + 1
        self.starts, self.start_doc = within_ranges(self.first[own], count), np.repeat(self.doc[own], count)
        a, b = (gram_hashes(h, self.starts, self.starts + self.window, k) for k, h in enumerate((self.h1, self.h2)))
        ids = self.ids[self.start_doc]
        bucket = B.bucket_of(a, WINDOW_BUCKETS * self.buckets)
        order = np.lexsort((ids, b, a, bucket))
        new = changes(a[order], b[order])
        self.group = np.empty(len(a), np.int64)
        self.group[order] = np.cumsum(new) - 1
        at = order[new]
        self.prints, self.print_bucket = (a[at], b[at], ids[at]), bucket[at] + self.buckets

    def send_contexts(self) -> list:
        rows = []
        for k, lo, hi in B.by_bucket(self.bucket):
            own = self.keep[lo:hi]
            n = self.n[own]
            words = self.h1[within_ranges(self.begin[own], n + self.window - 1)]
            head = [np.array([hi - lo], np.int64), self.distinct[self.anchor[own]], self.least[own], self.left[own].astype(np.uint16), n.astype(np.uint16)]
            rows.append((k, b"".join(x.tobytes() for x in (*head, words))))
        for k, lo, hi in B.by_bucket(self.print_bucket):
            rows.append((k, b"".join(c[lo:hi].tobytes() for c in self.prints)))
        return rows

    def repeated(self, answer: pa.Table) -> np.ndarray:
        """Starts of the windows that a document with a smaller doc_id has too."""
        n = self.n[self.keep]
        bits = B.read_bits(answer, 2, [(k, int(n[lo:hi].sum())) for k, lo, hi in B.by_bucket(self.bucket)])
        base = np.full(len(self.n), -1)
        base[self.keep] = np.cumsum(n) - n
        own = np.flatnonzero(base[self.entry] >= 0) if len(self.entry) else np.zeros(0, np.int64)
        count = self.last[own] - self.first[own] + 1
        smaller = np.repeat(self.ids[self.doc[own]] > self.least[self.entry[own]], count)  # within the block
        hit = within_ranges(self.first[own], count)[bits[within_ranges(base[self.entry[own]], count)] | smaller]
        found = B.read_bits(answer, 4, [(k, hi - lo) for k, lo, hi in B.by_bucket(self.print_bucket)])
        again = found[self.group] | (self.ids[self.start_doc] > self.prints[2][self.group])
        return np.concatenate([hit, self.starts[again]])


def anchor_flags(rows: pa.Table, most: int) -> pa.Table:
    """Stage 1: whether two documents have an anchor; stage 3: whether it may have more than ``most`` contexts."""
    blobs = rows.column("blob").to_pylist()
    sizes = [len(x) // 9 for x in blobs]
    h = np.concatenate([np.frombuffer(x, np.uint64, n) for x, n in zip(blobs, sizes, strict=True)])
    flag = np.concatenate([np.frombuffer(x, np.uint8, n, 8 * n) for x, n in zip(blobs, sizes, strict=True)])
    order = np.argsort(h, kind="stable")
    first = changes(h[order])
    start = np.flatnonzero(first)
    two = (np.diff(np.append(start, len(h))) > 1) | (np.maximum.reduceat(flag[order] & 1, start) > 0)
    contexts = np.add.reduceat(np.int64(1) << (flag[order] >> 1).astype(np.int64), start)
    out = np.empty((2, len(h)), bool)
    out[:, order] = np.stack([two, contexts > most])[:, np.cumsum(first) - 1]
    cuts = np.cumsum(sizes)[:-1]
    return pa.concat_tables([B.answers(rows, stage, [np.packbits(x).tobytes() for x in np.split(o, cuts)]) for stage, o in zip((1, 3), out, strict=True)])


def refine(classes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Classes split by the next word."""
    order = np.lexsort((words, classes))
    out = np.empty(len(classes), np.int64)
    out[order] = np.cumsum(changes(classes[order], words[order])) - 1
    return out


def smaller_matches(anchor, least, left, n, words, window: int, gram: int) -> np.ndarray:
    """For every window of every context, in order: whether a context with a
    smaller doc_id has it.  ``words`` are the contexts' word hashes, joined."""
    size = n + window - 1
    begin = np.cumsum(size) - size
    centre = begin + left  # the anchor's first word
    start = np.unique(anchor, return_inverse=True)[1].astype(np.int64)
    end = len(words)

    def extend(classes: np.ndarray, at: np.ndarray, inside: np.ndarray) -> np.ndarray:
        # a context that ends there is compared no further: its windows need no more
        step = np.where(inside, words[np.minimum(np.maximum(at, 0), end - 1)], np.uint64(0))
        return refine(classes * 2 + inside, step)

    right = {gram: start}
    for t in range(gram, window):
        right[t + 1] = extend(right[t], centre + t, left + t < size)
    flat, base = np.zeros(int(n.sum()), bool), np.cumsum(n) - n
    lefts = start
    for j in range(window - gram + 1):
        if j:
            lefts = extend(lefts, centre - j, left >= j)
        own = np.flatnonzero((left >= j) & (left - j < n))  # contexts with the window that starts j words before the anchor
        if len(own):
            code = lefts[own] * (len(n) + 1) + right[window - j][own]
            order = np.argsort(code, kind="stable")
            groups = np.flatnonzero(changes(code[order]))
            lowest = np.minimum.reduceat(least[own][order], groups)
            found = np.empty(len(own), bool)
            found[order] = np.repeat(lowest, np.diff(np.append(groups, len(own)))) < least[own][order]
            flat[base[own] + left[own] - j] = found
    return flat


def context_repeats(rows: pa.Table, window: int, gram: int) -> pa.Table:
    """Extend the contexts of every anchor of a bucket."""
    parts: list = [[], [], [], [], []]
    counts = []
    for blob in rows.column("blob").to_pylist():
        k = int(np.frombuffer(blob, np.int64, 1)[0])
        n = np.frombuffer(blob, np.uint16, k, 8 + 18 * k).astype(np.int64)
        for own, x in zip(parts, (np.frombuffer(blob, np.uint64, k, 8), np.frombuffer(blob, np.int64, k, 8 + 8 * k),
                                  np.frombuffer(blob, np.uint16, k, 8 + 16 * k).astype(np.int64), n,
                                  np.frombuffer(blob[8 + 20 * k:], np.uint64)), strict=True):
            own.append(x)
        counts.append(int(n.sum()))
    flat = smaller_matches(*(np.concatenate(p) for p in parts), window, gram)
    return B.answers(rows, 2, [np.packbits(x).tobytes() for x in np.split(flat, np.cumsum(counts)[:-1])])


def _smaller_elsewhere(rows: pa.Table) -> pa.Table:
    """Answers: whether a block's window starts in a document with a smaller id than the block's smallest."""
    cols, sizes = [[], [], []], []
    for x in rows.column("blob").to_pylist():
        n = len(x) // 24
        sizes.append(n)
        for c, kind, at in zip(cols, (np.uint64, np.uint64, np.int64), (0, 8 * n, 16 * n), strict=True):
            c.append(np.frombuffer(x, kind, n, at))
    a, b, m = (np.concatenate(c) for c in cols)
    order = np.lexsort((m, b, a))
    sa, sb = a[order], b[order]
    first = np.concatenate([[True], (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])])
    least = m[order][first][np.cumsum(first) - 1]
    out = np.empty(len(a), bool)
    out[order] = least < m[order]
    return B.answers(rows, 4, [np.packbits(x).tobytes() for x in np.split(out, np.cumsum(sizes)[:-1])])


def drop_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept (text) and repeats
    (maximal runs of removed words, as first and one past last)."""
    buckets, most = B.bucket_count(docs), HOT_CONTEXTS
    texts = B.text_blocks(docs)

    def anchors(key, rows):
        return B.sent(key[0].as_py(), _Windows(rows, buckets, window, gram).rows)

    def contexts(key, rows, answer):
        w = _Windows(rows, buckets, window, gram)
        w.seeded(answer)
        return B.sent(key[0].as_py(), w.send_contexts())

    run_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def finish(key, rows, answer):
        w = _Windows(rows, buckets, window, gram)
        w.seeded(answer)
        hit = w.repeated(answer)
        step = np.zeros(len(w.h1) + 1, np.int32)
        np.add.at(step, hit, 1)
        np.add.at(step, hit + window, -1)
        gone = np.cumsum(step[:-1]) > 0
        raw = w.data.tobytes()
        kept, spans, removed = [], [], []
        for k in range(len(w.ids)):
            own = raw[w.offs[k]:w.offs[k + 1]].split()
            g = gone[w.doc_words[k]:w.doc_words[k + 1]]
            n = int(np.count_nonzero(g))
            removed.append(n)
            kept.append(b" ".join(pick(own, ~g) if n else own))
            edge = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(np.int8), [0]]))) if n else np.zeros(0, np.int64)
            spans.append([{"first": int(x), "last": int(y)} for x, y in zip(edge[::2], edge[1::2], strict=True)])
        return pa.table({"doc_id": pa.array(w.ids, mask=w.ids == B.NO_ID), "n_words": np.diff(w.doc_words),
                         "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                         "repeats": pa.array(spans, run_type)})

    out = "doc_id long, n_words long, n_removed long, kept string, repeats array<struct<first:long,last:long>>"
    seeds = texts.groupBy("block").applyInArrow(anchors, B.SENT).groupBy("bucket").applyInArrow(lambda t: anchor_flags(t, most), B.ANSWER)
    found = texts.groupBy("block").cogroup(seeds.groupBy("block")).applyInArrow(contexts, B.SENT)
    extended = found.groupBy("bucket").applyInArrow(
        lambda key, t: context_repeats(t, window, gram) if key[0].as_py() < buckets else _smaller_elsewhere(t), B.ANSWER)
    return texts.groupBy("block").cogroup(seeds.unionByName(extended).groupBy("block")).applyInArrow(finish, out)


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = drop_repeats(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
