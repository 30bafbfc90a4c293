"""Suffix-array dedup of byte strings by deep-shallow sorting.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts
anywhere else, in the same document or another.  Every window of LENGTH bytes
has an anchor, its ``GRAM``-byte string with the smallest hash (the leftmost of
equals); equal windows have equal anchors at equal offsets.  Anchors that stand
once in the corpus are dropped; the rest meet in buckets with the bytes of the
windows they stand for, each distinct string once per block with a flag whether
it stands twice there.  An anchor with more than ``HOT_STRINGS`` strings (a
passage in many surroundings) is split by its windows instead: a 128-bit
fingerprint of every distinct window of a block goes to a bucket of its own, so
no bucket holds all strings of an anchor and the result is the same.  In a
bucket, the suffixes that start at one anchor's
occurrences are put in suffix-array order by deep-shallow sorting: multikey
quicksort on ``STEP``-byte characters down to a shallow depth, then a blind
trie per remaining group of long common prefixes, which also gives the lengths
of the common prefixes; the reversed strings before the anchor likewise.  A
window that starts j bytes before the anchor repeats when another occurrence
agrees in j bytes to the left and LENGTH - j to the right: both are runs of the
sorted orders.

Null texts count as empty, texts below LENGTH bytes stay whole, matches never
cross documents.  Repeated rows and doc_ids are documents of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm import blocks as B
from domus.llm.common import _byte_values, _powers, _span_sums, mix64, table, within_ranges

LENGTH = 400
GRAM = 160
STEP = 8
SHALLOW = 32
HOT_STRINGS = 4096  # strings of one anchor, over all blocks, that are sorted in one task
WINDOW_BUCKETS = 4  # buckets of window fingerprints for each bucket of anchors
_POS_BITS = 24


def gram_values(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from every position."""
    n = len(data)
    if n < gram:
        return np.zeros(0, np.uint64)
    p, q = _powers(0, n + 1)
    c = np.zeros(n + 1, np.uint64)
    np.cumsum(_byte_values(0)[data] * p[:n], out=c[1:])
    return mix64((c[gram:] - c[:-gram]) * q[:n - gram + 1])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, have = x, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(out) - (width - have)], out[width - have:]) if have < width else out


def window_anchors(data: np.ndarray, offs: np.ndarray, length: int, gram: int):
    """(anchor position, hash, first window start, last window start) of every
    anchor of a stretch of documents, in order."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, np.zeros(0, np.uint64), empty, empty
    g = gram_values(data, gram)
    n = np.maximum(0, np.diff(offs) - length + 1)
    starts = within_ranges(offs[:-1], n)
    if not len(starts):
        return empty, np.zeros(0, np.uint64), empty, empty
    low = np.uint64((1 << _POS_BITS) - 1)
    if len(g) <= 1 << _POS_BITS:
        # the smallest hash (by its high bits), then the leftmost position
        key = (g & ~low) | np.arange(len(g), dtype=np.uint64)
        best = (sliding_min(key, length - gram + 1)[starts] & low).astype(np.int64)
    else:  # one very long document: the same by ranges of positions that share their high bits
        best = np.empty(len(starts), np.int64)
        size = 1 << (_POS_BITS - 1)
        for lo in range(0, len(starts), size):
            own = starts[lo:lo + size]
            a, b = own[0], own[-1] + length - gram + 1
            key = (g[a:b] & ~low) | np.arange(b - a, dtype=np.uint64)
            best[lo:lo + size] = (sliding_min(key, length - gram + 1)[own - a] & low).astype(np.int64) + a
    doc = np.repeat(np.arange(len(n)), n)
    new = np.concatenate([[True], (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])])
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(starts)]]) - 1
    return best[at], g[best[at]], starts[at], starts[last]


class BlindTrie:
    """A Patricia trie of byte strings: nodes hold a depth and children by the
    byte there (-1: the string ends); leaves hold equal strings."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None

    def add(self, s: bytes, ident: int) -> None:
        if self.root is None:
            self.root = [s, [ident]]
            return
        # blind descent: branching bytes only
        node = self.root
        path = []
        while len(node) == 3:
            path.append(node)
            d, kids = node[0], node[1]
            nxt = kids.get(s[d] if d < len(s) else -1)
            node = nxt if nxt is not None else next(iter(kids.values()))
        other = node[0]
        if other == s:
            node[1].append(ident)
            return
        lcp = common_prefix(s, other)
        # the branch belongs above the first node at least that deep, whose strings all share the prefix
        parent, at = None, self.root
        for p in path:
            if p[0] >= lcp:
                break
            parent, at = p, p[1].get(s[p[0]] if p[0] < len(s) else -1)
        leaf = [s, [ident]]
        mine = s[lcp] if lcp < len(s) else -1
        if len(at) == 3 and at[0] == lcp:
            at[1][mine] = leaf
            return
        theirs = other[lcp] if lcp < len(other) else -1
        branch = [lcp, {theirs: at, mine: leaf}, None]
        if parent is None:
            self.root = branch
        else:
            parent[1][s[parent[0]] if parent[0] < len(s) else -1] = branch

    def ordered(self) -> tuple:
        """(ids in order, common prefix lengths with the one before)."""
        ids, lcps = [], []
        stack = [(self.root, 0)]
        while stack:
            node, lcp = stack.pop()
            if len(node) == 2:
                ids += node[1]
                lcps += [lcp] + [len(node[0])] * (len(node[1]) - 1)
            else:
                kids = [k for _, k in sorted(node[1].items())]
                stack += [(k, node[0]) for k in kids[:0:-1]]
                stack.append((kids[0], lcp))
        return ids, lcps


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def deep_shallow(strings: list) -> tuple:
    """Suffix order of the strings: (order, common prefix lengths with the string before)."""
    order, lcps = [], []
    # multikey quicksort on STEP-byte characters down to SHALLOW bytes
    stack = [(list(range(len(strings))), 0)]
    while stack:
        own, depth = stack.pop()
        if len(own) == 1:
            order.append(own[0])
            lcps.append(0)
            continue
        if depth >= SHALLOW:
            trie = BlindTrie()
            for i in own:
                trie.add(strings[i], i)
            ids, within = trie.ordered()
            order += ids
            lcps += within
            continue
        mid = strings[own[len(own) // 2]][depth:depth + STEP]
        less, same, more = [], [], []
        for i in own:
            c = strings[i][depth:depth + STEP]
            (same if c == mid else less if c < mid else more).append(i)
        # a group of strings that end here is in order
        ended = len(mid) < STEP
        stack += [(x, d) for x, d in ((more, depth), (same, SHALLOW if ended else depth + STEP), (less, depth)) if x]
    # boundaries between groups that the trie did not see
    for k in range(1, len(order)):
        if lcps[k] == 0:
            lcps[k] = common_prefix(strings[order[k - 1]], strings[order[k]])
    return order, lcps


def repeated_starts(texts: list, lefts: np.ndarray, counts: np.ndarray, length: int) -> list:
    """Occurrences of one anchor: for each, which of its windows another one
    has too.  ``texts`` run from the first window's start to the last one's
    end; ``lefts`` is the anchor's offset in them; a window k starts k bytes in."""
    m = len(texts)
    flat, base = np.zeros(int(counts.sum()), bool), np.cumsum(counts) - counts
    r_order, r_lcp = deep_shallow([t[x:] for t, x in zip(texts, lefts.tolist(), strict=True)])
    l_order, l_lcp = deep_shallow([t[:x][::-1] for t, x in zip(texts, lefts.tolist(), strict=True)])
    r_order, l_order, r_lcp, l_lcp = (np.array(x) for x in (r_order, l_order, r_lcp, l_lcp))
    jmax, jmin = int(lefts.max()), int((lefts - counts + 1).min())
    width = max(1, (1 << 20) // m)
    for lo in range(max(0, jmin), jmax + 1, width):
        j = np.arange(lo, min(lo + width, jmax + 1))
        right, left = np.empty((len(j), m), np.int64), np.empty((len(j), m), np.int64)
        right[:, r_order] = np.cumsum(r_lcp[None, :] < (length - j)[:, None], axis=1)
        left[:, l_order] = np.cumsum(l_lcp[None, :] < j[:, None], axis=1)
        # equal codes: strings that agree in j bytes to the left and length - j to the right
        code = right * (m + 1) + left
        order = np.argsort(code, axis=1, kind="stable")
        s = np.take_along_axis(code, order, axis=1)
        eq = s[:, 1:] == s[:, :-1]
        dup = np.zeros((len(j), m), bool)
        dup[:, 1:] |= eq
        dup[:, :-1] |= eq
        hit = np.zeros((len(j), m), bool)
        np.put_along_axis(hit, order, dup, axis=1)
        rows, cols = np.nonzero(hit)
        k = lefts[cols] - j[rows]  # the window's number in its occurrence
        real = (k >= 0) & (k < counts[cols])
        flat[base[cols[real]] + k[real]] = True
    return np.split(flat, base[1:])


def span_prints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple:
    """Two 64-bit hashes of every span's bytes."""
    return tuple(mix64(_span_sums(_byte_values(k)[data], starts, ends, k)) for k in (0, 1))


def changes(*cols: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before (the first does)."""
    out = np.zeros(len(cols[0]), bool)
    out[:1] = True
    for c in cols:
        out[1:] |= c[1:] != c[:-1]
    return out


class _Anchors:
    """What a block's passes compute alike.  An entry is a distinct (anchor
    hash, offset of the anchor, string) of the block."""

    def __init__(self, rows: pa.Table, buckets: int, length: int, gram: int):
        self.ids, self.data, self.offs = B.unpack(rows)
        self.length, self.buckets = length, buckets
        parts = []
        for k, part, o in B.sub_slices(self.data, self.offs):
            p, h, a, b = window_anchors(part, o, length, gram)
            base = self.offs[k]
            parts.append((p + base, h, a + base, b + base, *span_prints(part, a, b + length)))
        pos, anchor, self.first, self.last, x, y = (np.concatenate(c) for c in zip(*parts, strict=True))
        left, n = pos - self.first, self.last - self.first + 1
        order = np.lexsort((y, x, n, left, anchor))
        h = anchor[order]
        top, new = changes(h), changes(h, left[order], n[order], x[order], y[order])
        self.entry = np.empty(len(h), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        self.own = order[at]  # an occurrence of every entry
        self.twice = np.diff(np.append(at, len(h))) > 1
        self.anchor = (np.cumsum(top) - 1)[at]
        self.distinct, self.left, self.n = h[top], left[self.own], n[self.own]
        # 0: stands once; else 1 + the logarithm of the number of its strings
        start = np.flatnonzero(top)
        kinds = np.bincount(self.anchor, minlength=len(start))
        flag = np.where(np.diff(np.append(start, len(h))) > 1, 1 + np.ceil(np.log2(np.maximum(kinds, 1))), 0).astype(np.uint8)
        self.rows, self.sizes, self.order = B.send_distinct(self.distinct, flag, buckets)

    def seeded(self, answer: pa.Table) -> None:
        """Entries of anchors that stand twice in the corpus, by bucket; of hot anchors the distinct windows."""
        flags = np.zeros((2, len(self.distinct)), bool)
        for row, stage in zip(flags, (1, 3), strict=True):
            row[self.order] = B.read_bits(answer, stage, self.sizes)
        shared, hot = flags[0][self.anchor], flags[1][self.anchor]
        keep = np.flatnonzero(shared & ~hot)
        bucket = B.bucket_of(self.distinct[self.anchor[keep]], self.buckets)
        order = np.argsort(bucket, kind="stable")
        self.keep, self.bucket = keep[order], bucket[order]
        own = np.flatnonzero(hot[self.entry])
        self.windows = np.sort(within_ranges(self.first[own], self.last[own] - self.first[own] + 1))
        parts = [(np.zeros(0, np.uint64),) * 2]
        if len(own):
            for k, part, o in B.sub_slices(self.data, self.offs):
                lo, hi = np.searchsorted(self.windows, [self.offs[k], self.offs[k] + len(part)])
                at = self.windows[lo:hi] - self.offs[k]
                parts.append(span_prints(part, at, at + self.length))
        x, y = (np.concatenate(c) for c in zip(*parts, strict=True))
        bucket = B.bucket_of(x, WINDOW_BUCKETS * self.buckets)
        order = np.lexsort((y, x, bucket))
        new = changes(x[order], y[order])
        self.print_of = np.empty(len(x), np.int64)
        self.print_of[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        self.prints = x[order][at], y[order][at], (np.diff(np.append(at, len(x))) > 1).astype(np.uint8)
        self.print_bucket = bucket[order][at] + self.buckets

    def send_strings(self) -> list:
        rows = []
        raw = self.data.tobytes()
        for k, lo, hi in B.by_bucket(self.bucket):
            own = self.keep[lo:hi]
            head = np.array([hi - lo], np.int64).tobytes() + self.distinct[self.anchor[own]].tobytes()
            head += self.left[own].astype(np.int32).tobytes() + self.n[own].astype(np.int32).tobytes() + self.twice[own].astype(np.uint8).tobytes()
            at = self.first[self.own[own]]
            body = b"".join([raw[a:b] for a, b in zip(at.tolist(), (at + self.n[own] + self.length - 1).tolist(), strict=True)])
            rows.append((k, B.compress(head + body)))
        for k, lo, hi in B.by_bucket(self.print_bucket):
            rows.append((k, b"".join(c[lo:hi].tobytes() for c in self.prints)))
        return rows

    def repeated(self, answer: pa.Table) -> np.ndarray:
        """Starts of the windows that stand twice in the corpus."""
        n = self.n[self.keep]
        bits = B.read_bits(answer, 2, [(k, int(n[lo:hi].sum())) for k, lo, hi in B.by_bucket(self.bucket)])
        base = np.full(len(self.own), -1)
        base[self.keep] = np.cumsum(n) - n
        own = np.flatnonzero(base[self.entry] >= 0) if len(self.entry) else np.zeros(0, np.int64)
        count = self.last[own] - self.first[own] + 1
        hit = within_ranges(self.first[own], count)[bits[within_ranges(base[self.entry[own]], count)]]
        found = B.read_bits(answer, 4, [(k, hi - lo) for k, lo, hi in B.by_bucket(self.print_bucket)])
        return np.concatenate([hit, self.windows[found[self.print_of]]])


def anchor_flags(rows: pa.Table) -> pa.Table:
    """Stage 1: whether an anchor stands twice; stage 3: whether it may have more than HOT_STRINGS strings."""
    blobs = rows.column("blob").to_pylist()
    sizes = [len(x) // 9 for x in blobs]
    h = np.concatenate([np.frombuffer(x, np.uint64, n) for x, n in zip(blobs, sizes, strict=True)])
    flag = np.concatenate([np.frombuffer(x, np.uint8, n, 8 * n) for x, n in zip(blobs, sizes, strict=True)])
    order = np.argsort(h, kind="stable")
    first = changes(h[order])
    strings = np.int64(1) << np.maximum(flag[order].astype(np.int64) - 1, 0)
    hot = np.empty(len(h), bool)
    hot[order] = (np.add.reduceat(strings, np.flatnonzero(first)) > HOT_STRINGS)[np.cumsum(first) - 1]
    hot = [np.packbits(x).tobytes() for x in np.split(hot, np.cumsum(sizes)[:-1])]
    return pa.concat_tables([B.shared_flags(rows, 1), B.answers(rows, 3, hot)])


def window_repeats(rows: pa.Table) -> pa.Table:
    """Whether window fingerprints are flagged or stand in two blocks."""
    blobs = rows.column("blob").to_pylist()
    sizes = [len(x) // 17 for x in blobs]
    x, y, flag = (np.concatenate([np.frombuffer(b, kind, n, at * n) for b, n in zip(blobs, sizes, strict=True)])
                  for kind, at in ((np.uint64, 0), (np.uint64, 8), (np.uint8, 16)))
    order = np.lexsort((y, x))
    first = changes(x[order], y[order])
    start = np.flatnonzero(first)
    many = (np.diff(np.append(start, len(x))) > 1) | (np.maximum.reduceat(flag[order], start) > 0)
    out = np.empty(len(x), bool)
    out[order] = many[np.cumsum(first) - 1]
    return B.answers(rows, 4, [np.packbits(p).tobytes() for p in np.split(out, np.cumsum(sizes)[:-1])])


def _pairs(texts: list, lefts: np.ndarray, counts: np.ndarray, first: np.ndarray, second: np.ndarray, length: int, out: list) -> None:
    """Anchors with two occurrences: the longest agreement to either side gives
    the repeated windows, without sorting."""
    for a, b in zip(first.tolist(), second.tolist(), strict=True):
        s, t, x, y = texts[a], texts[b], int(lefts[a]), int(lefts[b])
        if s == t and x == y:
            out[a][:] = True
            out[b][:] = True
            continue
        right = common_prefix(s[x:], t[y:])
        left = common_prefix(s[:x][::-1], t[:y][::-1])
        lo = max(length - right, 0)
        if lo <= left:
            for o, z in ((out[a], x), (out[b], y)):
                o[max(0, z - left):max(0, z - lo + 1)] = True


def bucket_repeats(rows: pa.Table, length: int) -> pa.Table:
    hashes, lefts, counts, twice, texts, sizes = [], [], [], [], [], []
    for blob in rows.column("blob").to_pylist():
        raw = B.decompress(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        hashes.append(np.frombuffer(raw, np.uint64, n, 8))
        left, count = np.frombuffer(raw, np.int32, n, 8 + 8 * n), np.frombuffer(raw, np.int32, n, 8 + 12 * n)
        lefts.append(left)
        counts.append(count)
        twice.append(np.frombuffer(raw, np.uint8, n, 8 + 16 * n))
        sizes.append(n)
        ends = 8 + 17 * n + np.cumsum(count + (length - 1))
        texts += [raw[a:b] for a, b in zip(np.concatenate([[8 + 17 * n], ends[:-1]]).tolist(), ends.tolist(), strict=True)]
    h, lefts, counts = np.concatenate(hashes), np.concatenate(lefts).astype(np.int64), np.concatenate(counts).astype(np.int64)
    order = np.argsort(h, kind="stable")
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(h[order])) + 1, [len(h)]])
    flags = [np.zeros(c, bool) for c in counts.tolist()]
    size = np.diff(cuts)
    two = cuts[:-1][size == 2]
    _pairs(texts, lefts, counts, order[two], order[two + 1], length, flags)
    for lo, hi in zip(cuts[:-1][size > 2].tolist(), cuts[1:][size > 2].tolist(), strict=True):
        own = order[lo:hi]
        # equal strings are one, and repeat whole
        group: dict = {}
        for i in own.tolist():
            group.setdefault((texts[i], int(lefts[i])), []).append(i)
        keys = list(group)
        if len(keys) > 1:
            found = repeated_starts([k[0] for k in keys], np.array([k[1] for k in keys]), np.array([counts[group[k][0]] for k in keys]), length)
        else:
            found = [np.zeros(int(counts[own[0]]), bool)]
        for k, f in zip(keys, found, strict=True):
            for i in group[k]:
                flags[i] = np.ones_like(f) if len(group[k]) > 1 else f
    for i in np.flatnonzero(np.concatenate(twice)).tolist():
        flags[i] = np.ones(int(counts[i]), bool)
    out, at = [], 0
    for n in sizes:
        out.append(np.packbits(np.concatenate(flags[at:at + n])).tobytes() if n else b"")
        at += n
    return B.answers(rows, 2, out)


def drop_repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining
    bytes) and spans (maximal removed runs as byte offsets)."""
    buckets = B.bucket_count(docs)
    texts = B.text_blocks(docs)

    def anchors(key, rows):
        return B.sent(key[0].as_py(), _Anchors(rows, buckets, length, gram).rows)

    def strings(key, rows, answer):
        w = _Anchors(rows, buckets, length, gram)
        w.seeded(answer)
        return B.sent(key[0].as_py(), w.send_strings())

    run_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def finish(key, rows, answer):
        w = _Anchors(rows, buckets, length, gram)
        w.seeded(answer)
        hit = w.repeated(answer)
        step = np.zeros(len(w.data) + 1, np.int32)
        np.add.at(step, hit, 1)
        np.add.at(step, hit + length, -1)
        gone = np.cumsum(step[:-1]) > 0
        raw = w.data.tobytes()
        kept, spans, removed = [], [], []
        for a, b in zip(w.offs[:-1].tolist(), w.offs[1:].tolist(), strict=True):
            g = gone[a:b]
            if g.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(np.int8), [0]])))
                kept.append(w.data[a:b][~g].tobytes())
                spans.append([{"first": int(x), "last": int(y)} for x, y in zip(edge[::2], edge[1::2], strict=True)])
                removed.append(int(np.count_nonzero(g)))
            else:
                kept.append(raw[a:b])
                spans.append([])
                removed.append(0)
        return pa.table({"doc_id": pa.array(w.ids, mask=w.ids == B.NO_ID), "n_bytes": np.diff(w.offs), "n_removed": pa.array(removed, pa.int64()),
                         "n_spans": pa.array([len(s) for s in spans], pa.int64()), "kept": pa.array(kept, pa.binary()),
                         "spans": pa.array(spans, run_type)})

    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<first:long,last:long>>"
    seeds = texts.groupBy("block").applyInArrow(anchors, B.SENT).groupBy("bucket").applyInArrow(anchor_flags, B.ANSWER)
    found = texts.groupBy("block").cogroup(seeds.groupBy("block")).applyInArrow(strings, B.SENT)
    repeats = found.groupBy("bucket").applyInArrow(
        lambda key, t: bucket_repeats(t, length) if key[0].as_py() < buckets else window_repeats(t), B.ANSWER)
    return texts.groupBy("block").cogroup(seeds.unionByName(repeats).groupBy("block")).applyInArrow(finish, out)


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = drop_repeated_bytes(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
