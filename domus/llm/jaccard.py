"""Exact n-gram Jaccard join in metric space, with components.

A document is the set of its distinct word n-grams.  Two sets are linked when
their similarity is at least ``percent`` / 100.  Equal sets are one class.

The symmetric difference is a metric, and linked sets x, y satisfy
|x ^ y| <= D = (|x| + |y|) (1 - t) / (1 + t).  By the triangle inequality against
the parts of a partition of the n-gram space into more than D parts, at least
one non-empty part is cut alike from both.  So the first document that cuts a
part a certain way is the pivot of a region, and every document goes to the
regions of the pivots it shares a part with: its own cell and, as a boundary
document, those of its neighbours.  (Pivots drawn at random give no regions
here: unrelated documents all lie at distance 1 from every pivot.)  Sizes of
linked sets differ by the factor t at most, so parts are made per size band
and a document also takes part in the next larger band.

Before texts move, every region sees the sizes and sketches of its documents
(counts by cells of the n-gram space, whose L1 distance bounds the symmetric
difference from below) and drops documents that can have no link there; a region
of more than ``REGION_DOCS`` documents does so by size bands, chunk against chunk.  A region is then
joined exactly and recursively: the distances to its pivot link
what lies within the radius; every document outside the largest component is a
pivot in turn, and is compared with the documents whose distance to the first
pivot differs by the radius at most (triangle inequality).  Regions of more
than ``REGION_DOCS`` documents are joined in chunks with the same windows.

Documents without words have an empty set and no links.  Null texts and null
doc_ids are allowed (a null id counts as larger than any other).  A node of the
graph is a distinct set, named (smallest doc_id, 128-bit fingerprint): rows that
share a doc_id, or have none, are linked by their texts only, and each give a
row.  One document of the corpus stands for each set.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm import blocks as B
from domus.llm.common import LOWER, SPACE_WORDS, gram_hashes, materialise, mix64, table, word_hashes, word_spans

GRAM = 3
PERCENT = 90
REGION_DOCS = 4096
BROADCAST_IDS = 2_000_000


class Bands:
    """Size bands and the number of parts of each: linked sets lie in the same band or in neighbours."""

    def __init__(self, percent: int):
        self.percent = percent
        self.starts = [1]
        while self.starts[-1] < 1 << 40:
            self.starts.append(self.starts[-1] * 100 // percent + 1)
        self.difference = [2 * (hi - 1) * (100 - percent) // (100 + percent) for hi in self.starts[1:]]
        # a few more parts than the difference, so that enough of them are not empty
        self.parts = []
        for lo, d in zip(self.starts, self.difference, strict=False):
            m = d + 1
            for _ in range(20):
                m = int(np.ceil((d + 1) / max(1 - np.exp(-lo / m), 0.05) * 1.02)) + 1
            self.parts.append(m)
        self.starts = np.array(self.starts)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.starts, size, side="right")) - 1


def shingle_sets(data: np.ndarray, offs: np.ndarray, gram: int) -> list:
    """The sorted distinct n-gram hashes of every document of a stretch."""
    low = LOWER[data]
    s, e, dw = word_spans(low, offs, SPACE_WORDS)
    h = word_hashes(low, s, e)
    n = np.diff(dw)
    at = np.arange(max(0, len(h) - gram + 1))
    g = gram_hashes(h, at, at + gram)
    few = np.flatnonzero((n > 0) & (n < gram))
    whole = dict(zip(few.tolist(), gram_hashes(h, dw[few], dw[few + 1]), strict=True))
    out = []
    for k, (a, c) in enumerate(zip(dw[:-1].tolist(), n.tolist(), strict=True)):
        if c >= gram:
            x = np.sort(g[a:a + c - gram + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif c:
            out.append(np.array([whole[k]], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def block_sets(data: np.ndarray, offs: np.ndarray, gram: int) -> list:
    return [x for _, part, o in B.sub_slices(data, offs) for x in shingle_sets(part, o, gram)]


def fingerprints(sets: list) -> np.ndarray:
    """Two 64-bit sums per set (equal for equal sets)."""
    a = np.array([mix64(x).sum(dtype=np.uint64) if len(x) else 0 for x in sets], np.uint64)
    b = np.array([mix64(x ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64) if len(x) else 0 for x in sets], np.uint64)
    return np.stack([a, b], axis=1)


def part_cuts(x: np.ndarray, bands: Bands) -> np.ndarray:
    """Hashes of what a set cuts from the parts of its band and the next one."""
    home = bands.of(len(x))
    value = mix64(x + np.uint64(0x632BE59BD9B4E019))
    total = np.concatenate([[np.uint64(0)], np.cumsum(value, dtype=np.uint64)])
    high = x >> np.uint64(32)
    out = []
    for band in (home, home + 1):
        d, m = bands.difference[band], bands.parts[band]
        if d == 0:
            continue  # only equal sets are linked here
        edges = np.searchsorted(high * np.uint64(m) >> np.uint64(32), np.arange(m + 1, dtype=np.uint64))
        held = np.diff(edges)
        cut = total[edges[1:]] - total[edges[:-1]]
        name = mix64(np.arange(m, dtype=np.uint64) + np.uint64(band << 40))
        sig = mix64(cut ^ name)
        full = held > 0
        # with more than D non-empty parts an equal one is not empty; else empty parts count too
        out.append(sig[full] if np.count_nonzero(full) > d else sig)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class _Sets:
    """What a block's passes compute alike."""

    def __init__(self, rows: pa.Table, buckets: int, gram: int):
        self.ids, self.data, self.offs = B.unpack(rows)
        self.sets = block_sets(self.data, self.offs, gram)
        self.buckets = buckets
        fp = fingerprints(self.sets)
        self.x, self.y = fp[:, 0].copy(), fp[:, 1].copy()
        self.sizes = np.array([len(x) for x in self.sets], np.int64)
        full = np.flatnonzero(self.sizes > 0)
        bucket = B.bucket_of(self.x[full], buckets)
        # the documents by set, and one (the smallest doc_id) of each set
        self.full = full[np.lexsort((self.ids[full], self.y[full], self.x[full], bucket))]
        x, y = self.x[self.full], self.y[self.full]
        new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]) if len(full) else np.zeros(0, bool)
        self.kind, self.heads, self.rows, self.f_sizes = np.cumsum(new) - 1, self.full[new], [], []
        for k, lo, hi in B.by_bucket(B.bucket_of(self.x[self.heads], buckets)):
            own = self.heads[lo:hi]
            self.rows.append((k, self.x[own].tobytes() + self.y[own].tobytes() + self.ids[own].tobytes()))
            self.f_sizes.append((k, hi - lo))

    def classes(self, answer: pa.Table):
        """The smallest doc_id with the same set, for every document; the documents that stand for their set in the corpus."""
        out = self.ids.copy()
        have = {r["bucket"]: r["bits"] for r in answer.to_pylist() if r["stage"] == 1}
        if not self.f_sizes:
            return out, np.zeros(0, np.int64)
        least = np.concatenate([np.frombuffer(have[k], np.int64, n) for k, n in self.f_sizes])
        mine = np.concatenate([np.unpackbits(np.frombuffer(have[k], np.uint8, offset=8 * n), count=n) for k, n in self.f_sizes])
        out[self.full] = least[self.kind]
        return out, np.sort(self.heads[mine.astype(bool)])

    def cuts(self, answer: pa.Table, bands: Bands) -> list:
        """Distinct part cuts of the block's class heads, with the smallest fingerprint of each, by bucket."""
        heads = self.classes(answer)[1]
        sigs = [part_cuts(self.sets[k], bands) for k in heads.tolist()]
        doc = np.repeat(heads, [len(s) for s in sigs])
        sig = np.concatenate(sigs) if sigs else np.zeros(0, np.uint64)
        bucket = B.bucket_of(sig, self.buckets)
        order = np.lexsort((self.x[doc], sig, bucket))
        self.sig, self.doc = sig[order], doc[order]
        bucket = bucket[order]
        self.first = np.concatenate([[True], self.sig[1:] != self.sig[:-1]]) if len(sig) else np.zeros(0, bool)
        start = np.flatnonzero(self.first)
        least = self.x[self.doc][start]
        many = (np.diff(np.append(start, len(sig))) > 1).astype(np.uint8)
        rows, self.s_sizes = [], []
        for k, lo, hi in B.by_bucket(bucket[start]):
            rows.append((k, self.sig[start[lo:hi]].tobytes() + least[lo:hi].tobytes() + many[lo:hi].tobytes()))
            self.s_sizes.append((k, hi - lo))
        return rows

    def regions(self, answer: pa.Table):
        """(document, region) pairs, distinct; a region's name is the first half of its pivot's fingerprint."""
        have = {r["bucket"]: r["bits"] for r in answer.to_pylist() if r["stage"] == 2}
        pivots = [np.frombuffer(have[k], np.int64, n) for k, n in self.s_sizes]
        flags = [np.unpackbits(np.frombuffer(have[k], np.uint8, offset=8 * n), count=n).astype(bool) for k, n in self.s_sizes]
        pivot, shared = (np.concatenate(x)[np.cumsum(self.first) - 1] if x else np.zeros(0, kind)
                         for x, kind in ((pivots, np.int64), (flags, bool)))
        pairs = np.unique(np.stack([self.doc[shared], pivot[shared]], axis=1), axis=0) if shared.any() else np.zeros((0, 2), np.int64)
        return pairs[:, 0], pairs[:, 1]


def _class_heads(rows: pa.Table) -> pa.Table:
    """The smallest doc_id of every set, and a bit for the one block that stands for it."""
    rows = rows.sort_by("block")  # so that a repeated run chooses the same block
    cols, sizes = [[], [], []], []
    for x in rows.column("blob").to_pylist():
        n = len(x) // 24
        sizes.append(n)
        for c, kind, at in zip(cols, (np.uint64, np.uint64, np.int64), (0, 8 * n, 16 * n), strict=True):
            c.append(np.frombuffer(x, kind, n, at))
    a, b, i = (np.concatenate(c) for c in cols)
    order = np.lexsort((i, b, a))
    sa, sb = a[order], b[order]
    first = np.concatenate([[True], (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])])
    out, mine = np.empty(len(a), np.int64), np.empty(len(a), bool)
    out[order], mine[order] = i[order][first][np.cumsum(first) - 1], first
    cuts = np.cumsum(sizes)[:-1]
    return B.answers(rows, 1, [x.tobytes() + np.packbits(f).tobytes() for x, f in zip(np.split(out, cuts), np.split(mine, cuts), strict=True)])


def _pivots(rows: pa.Table) -> pa.Table:
    """The smallest fingerprint that makes a cut, and a bit per cut whether two documents make it."""
    sig, ids, many, sizes = [], [], [], []
    for x in rows.column("blob").to_pylist():
        n = len(x) // 17
        sizes.append(n)
        sig.append(np.frombuffer(x, np.uint64, n))
        ids.append(np.frombuffer(x, np.uint64, n, 8 * n))
        many.append(np.frombuffer(x, np.uint8, n, 16 * n))
    sig, ids, many = np.concatenate(sig), np.concatenate(ids), np.concatenate(many)
    order = np.argsort(sig, kind="stable")
    s = sig[order]
    first = np.concatenate([[True], s[1:] != s[:-1]])
    start = np.flatnonzero(first)
    least = np.minimum.reduceat(ids[order], start)
    shared = (np.maximum.reduceat(many[order], start) > 0) | (np.diff(np.append(start, len(s))) > 1)
    out, two = np.empty(len(sig), np.uint64), np.empty(len(sig), bool)
    group = np.cumsum(first) - 1
    out[order], two[order] = least[group], shared[group]
    cuts = np.cumsum(sizes)[:-1]
    return B.answers(rows, 2, [np.where(f, x, 0).tobytes() + np.packbits(f).tobytes()
                               for x, f in zip(np.split(out, cuts), np.split(two, cuts), strict=True)])


def sketch(x: np.ndarray) -> np.ndarray:
    """Counts of a set's n-grams in equal cells of the hash space (256 at least
    count as 255).  Their L1 distance never exceeds the symmetric difference."""
    bits = min(10, max(4, int(np.ceil(np.log2(max(len(x), 1) / 6)))))
    return np.minimum(np.bincount((x >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8)


def sketch_matrix(sketches: list) -> np.ndarray:
    """Sketches folded to the coarsest of them."""
    k = min(len(x) for x in sketches)
    return np.stack([x.astype(np.int32) if len(x) == k else x.reshape(k, -1).sum(axis=1, dtype=np.int32) for x in sketches])


def may_link(s: np.ndarray, sizes: np.ndarray, k: int, others, percent: int) -> np.ndarray:
    """Whether sizes and sketches leave a link of ``k`` with the others possible."""
    total = sizes[others] + sizes[k]
    return np.abs(s[others] - s[k]).sum(axis=1) * (100 + percent) <= total * (100 - percent)


def survivors(sizes: np.ndarray, sketches: list, percent: int) -> np.ndarray:
    """Which documents of a region may have a link there."""
    order = np.argsort(sizes, kind="stable")
    n, s = sizes[order], sketch_matrix([sketches[i] for i in order.tolist()])
    last = np.searchsorted(n, n * 100 // percent, side="right")
    out = np.zeros(len(n), bool)
    for k in range(len(n) - 1):
        if last[k] > k + 1:
            ok = may_link(s, n, k, slice(k + 1, int(last[k])), percent)
            if ok.any():
                out[k] = True
                out[k + 1:last[k]] |= ok
    keep = np.empty(len(n), bool)
    keep[order] = out
    return keep


def survivors_across(sizes: np.ndarray, sketches: list, side: np.ndarray, percent: int) -> np.ndarray:
    """Which documents may have a link with one of the other side."""
    order = np.lexsort((sizes, side))
    n, s = sizes[order], sketch_matrix([sketches[i] for i in order.tolist()])
    m = int((side == 0).sum())
    lo = m + np.searchsorted(n[m:], -(-n[:m] * percent // 100), side="left")
    hi = m + np.searchsorted(n[m:], n[:m] * 100 // percent, side="right")
    out = np.zeros(len(n), bool)
    for k, (a, b) in enumerate(zip(lo.tolist(), hi.tolist(), strict=True)):
        if a < b:
            ok = may_link(s, n, k, slice(a, b), percent)
            if ok.any():
                out[k] = True
                out[a:b] |= ok
    keep = np.empty(len(n), bool)
    keep[order] = out
    return keep


class Region:
    """The sets of a region's documents over one numbering of their n-grams."""

    def __init__(self, sets: list):
        self.sizes = np.array([len(x) for x in sets], np.int64)
        values, number = np.unique(np.concatenate(sets), return_inverse=True)
        self.tokens, self.n = number, len(values)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def common(self, k: int, others: np.ndarray | None = None) -> np.ndarray:
        """Intersection sizes of document ``k`` with all (or some) documents."""
        mark = np.zeros(self.n, np.int64)
        mark[self.tokens[self.starts[k]:self.starts[k] + self.sizes[k]]] = 1
        if others is None:
            return np.add.reduceat(mark[self.tokens], self.starts)
        n = self.sizes[others]
        at = np.cumsum(n) - n
        pick = np.arange(int(n.sum())) - np.repeat(at, n) + np.repeat(self.starts[others], n)
        return np.add.reduceat(mark[self.tokens[pick]], at)


def linked(common: np.ndarray, a, b, percent: int) -> np.ndarray:
    return 100 * common >= percent * (a + b - common)


def join_region(sets: list, percent: int, targets: int | None = None) -> np.ndarray:
    """Component number of every (non-empty) set.  With ``targets`` the first so
    many sets are known to be one component and are not compared with each other."""
    m = len(sets)
    r = Region(sets)
    comp = np.arange(m)
    if targets:
        comp[:targets] = 0
    common = r.common(0)
    distance = 1 - common / (r.sizes + r.sizes[0] - common)
    near = linked(common, r.sizes, r.sizes[0], percent)
    comp[np.isin(comp, comp[near])] = comp[0]
    radius = 1 - percent / 100 + 1e-9
    sketches = sketch_matrix([sketch(x) for x in sets])
    done = np.zeros(m, bool)
    done[0] = True
    while True:
        counts = np.bincount(comp, minlength=m)
        rest = np.flatnonzero(~done & (comp != counts.argmax()))
        if not len(rest):
            return comp
        # a pivot of the largest component that is still open, so that it closes soon
        k = int(rest[np.argmax(counts[comp[rest]])])
        done[k] = True
        window = np.flatnonzero((np.abs(distance - distance[k]) <= radius) & (comp != comp[k])
                                & (100 * r.sizes >= percent * r.sizes[k]) & (100 * r.sizes[k] >= percent * r.sizes))
        window = window[may_link(sketches, r.sizes, k, window, percent)]
        if len(window):
            c = r.common(k, window)
            hit = window[linked(c, r.sizes[window], r.sizes[k], percent)]
            if len(hit):
                own = np.append(comp[hit], comp[k])
                comp[np.isin(comp, own)] = own.min()


_NODE = ("id", "x", "y")  # a set: its smallest doc_id and its fingerprint
_EDGE = ", ".join(f"{v}_{c} long" for v in "ab" for c in _NODE)


def _edges(nodes: list, comp: np.ndarray):
    """The columns of (set, smallest set of its component) for sets that are not it."""
    order = np.lexsort((*nodes[::-1], comp))
    c = comp[order]
    first = np.concatenate([[True], c[1:] != c[:-1]])
    least = np.empty(len(comp), np.int64)
    least[order] = order[first][np.cumsum(first) - 1]
    other = np.flatnonzero(least != np.arange(len(comp)))
    return [n[other] for n in nodes] + [n[least[other]] for n in nodes]


def _edge_table(parts: list) -> pa.Table:
    cols = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 6
    return pa.table(dict(zip([f"{v}_{c}" for v in "ab" for c in _NODE], cols, strict=True)))


def _nodes(rows: pa.Table) -> list:
    return [rows.column(c).to_numpy() for c in _NODE]


def region_edges(regions: DataFrame, large: DataFrame, gram: int, percent: int, buckets: int) -> DataFrame:
    """Edges (a, b) that give every region's components; ``large`` has the
    regions (and their counts) that are joined in chunks."""
    def unpack(payloads: list) -> list:
        raws = [B.decompress(p) for p in payloads]
        return block_sets(np.frombuffer(b"".join(raws), np.uint8), np.cumsum([0, *map(len, raws)]).astype(np.int64), gram)

    def small(rows):
        rows = rows.sort_by([("region", "ascending"), *((c, "ascending") for c in _NODE)])
        region, nodes = rows.column("region").to_numpy(), _nodes(rows)
        payload = rows.column("payload")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(region)) + 1, [len(region)]])
        parts = []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if hi - lo > 1:
                parts.append(_edges([n[lo:hi] for n in nodes], join_region(unpack(payload.slice(lo, hi - lo).to_pylist()), percent)))
        return _edge_table(parts)

    key = F.pmod(F.xxhash64("region"), F.lit(buckets)).cast("int").alias("bucket")
    if large.isEmpty():
        return regions.select(key, "region", *_NODE, "payload").groupBy("bucket").applyInArrow(small, _EDGE)
    rest = regions.join(large, "region", "left_anti").select(key, "region", *_NODE, "payload").groupBy("bucket").applyInArrow(small, _EDGE)
    return rest.unionByName(large_region_edges(regions.join(large, "region"), unpack, percent))


def large_regions(near: DataFrame) -> DataFrame:
    """(region, count) of the regions that are joined in chunks."""
    return near.groupBy("region").count().filter(F.col("count") > REGION_DOCS)


def by_size(near: DataFrame, large: DataFrame) -> tuple:
    """The rows of the regions whose sketches one task compares, and those of
    ``large``, compared in cells (None without any)."""
    if large.isEmpty():
        return near, None
    return near.join(large, "region", "left_anti"), near.join(large, "region", "left_semi")


_WANTED = "block string, region long, row long, id long, x long, y long"


def possible_in_cells(many: DataFrame, bands: Bands, percent: int) -> DataFrame:
    """The documents of regions of any size that may have a link there.  Linked
    sets lie in the same size band or in neighbours, so every chunk of a band's
    documents meets the chunks of its own band and of the next one."""
    starts = F.array(*[F.lit(int(x)).cast("long") for x in bands.starts])
    rows = many.withColumn("band", F.size(F.filter(starts, lambda x: x <= F.col("n_shingles"))))
    chunks = F.ceil(F.count(F.lit(1)) / F.lit(REGION_DOCS)).cast("int")
    held = materialise(rows.groupBy("region", "band").agg(chunks.alias("n_own")), "jaccard-bands")  # one row a band of a large region
    beside = held.join(held.select("region", (F.col("band") - 1).alias("band"), F.col("n_own").alias("n_next")), ["region", "band"], "left")
    beside = beside.join(held.select("region", (F.col("band") + 1).alias("band"), F.col("n_own").alias("n_last")), ["region", "band"], "left")
    rows = rows.join(beside, ["region", "band"]).withColumn("chunk", F.pmod(F.xxhash64("x"), F.col("n_own")).cast("int"))
    c, band, none = F.col("chunk"), F.col("band"), F.array().cast("array<int>")

    def upto(n):
        return F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(none)

    def cell(lower, across, u, v, side):
        return F.struct(lower.alias("lower"), F.lit(across).alias("across"), u.alias("u"), v.alias("v"), side.cast("int").alias("side"))

    cells = F.concat(F.transform(upto("n_own"), lambda v: cell(band, 0, F.least(c, v), F.greatest(c, v), c > v)),
                     F.transform(upto("n_next"), lambda v: cell(band, 1, c, v, F.lit(0))),
                     F.transform(upto("n_last"), lambda v: cell(band - 1, 1, v, c, F.lit(1))))
    rows = rows.select("block", "region", "row", *_NODE, "n_shingles", "sketch", F.inline(cells))

    def possible(t):
        t = t.sort_by([(x, "ascending") for x in _NODE])
        size, side = t.column("n_shingles").to_numpy(), t.column("side").to_numpy()
        sketches = [np.frombuffer(x, np.uint8) for x in t.column("sketch").to_pylist()]
        within = not t.column("across")[0].as_py() and t.column("u")[0].as_py() == t.column("v")[0].as_py()
        keep = survivors(size, sketches, percent) if within else survivors_across(size, sketches, side, percent)
        return t.select(["block", "region", "row", *_NODE]).filter(pa.array(keep))

    return rows.groupBy("region", "lower", "across", "u", "v").applyInArrow(possible, _WANTED).distinct()


def chunked_regions(wanted: DataFrame) -> DataFrame:
    """(region, count, pivot) of the regions that are joined in chunks."""
    each = wanted.groupBy("region").agg(F.count(F.lit(1)).alias("count"), F.min(F.struct(*_NODE)).alias("pivot_node"))
    return each.filter(F.col("count") > REGION_DOCS)


def large_region_edges(rows: DataFrame, unpack, percent: int) -> DataFrame:
    """Regions of any size in chunks: distances to the pivot first, chunk by
    chunk; what the pivot links is one component.  Then every chunk of the other
    documents meets every chunk of the region."""
    chunk = F.pmod(F.xxhash64("x"), F.ceil(F.col("count") / F.lit(REGION_DOCS)).cast("long")).cast("int")
    rows = rows.withColumn("n_chunks", F.ceil(F.col("count") / F.lit(REGION_DOCS)).cast("int"))
    # the pivot goes to every chunk
    own = rows.withColumn("chunk", chunk).select("region", "chunk", "n_chunks", *_NODE, "payload", F.lit(False).alias("pivot"))
    pivot = rows.filter(F.struct(*_NODE) == F.col("pivot_node")).select("region", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("chunk"), "n_chunks",
                                               *_NODE, "payload", F.lit(True).alias("pivot"))

    def measure(t):
        t = t.sort_by([("pivot", "descending"), *((c, "ascending") for c in _NODE)])
        sets = unpack(t.column("payload").to_pylist())
        r = Region(sets)
        common = r.common(0)
        near = linked(common, r.sizes, r.sizes[0], percent)
        keep = pa.array(~t.column("pivot").to_numpy())
        far = 1 - common / (r.sizes + r.sizes[0] - common)
        for c in _NODE:
            t = t.append_column("pivot_" + c, pa.array(np.full(len(t), t.column(c)[0].as_py()), pa.int64()))
        return t.append_column("near", pa.array(near)).append_column("distance", pa.array(far)).filter(keep)

    fields = "region long, chunk int, n_chunks int, id long, x long, y long, payload binary, pivot boolean, " \
             "pivot_id long, pivot_x long, pivot_y long, near boolean, distance double"
    measured = materialise(own.unionByName(pivot).groupBy("region", "chunk").applyInArrow(measure, fields), "jaccard-measured")
    star = measured.filter("near and not (id = pivot_id and x = pivot_x and y = pivot_y)").select(
        *(F.col(c).alias("a_" + c) for c in _NODE), *(F.col("pivot_" + c).alias("b_" + c) for c in _NODE))
    # documents outside the radius, against the whole region
    out = measured.filter("not near").select("region", "chunk", *_NODE, "payload", "n_chunks", "distance")
    left = out.select("region", F.col("chunk").alias("u"), F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("v"), *_NODE, "payload",
                      F.lit(0).alias("side"), "distance")
    spans = out.groupBy("region", F.col("chunk").alias("u")).agg(F.min("distance").alias("lo"), F.max("distance").alias("hi"))
    radius = 1 - percent / 100 + 1e-9
    right = measured.join(spans, "region").filter((F.col("distance") >= F.col("lo") - radius) & (F.col("distance") <= F.col("hi") + radius))
    right = right.select("region", "u", F.col("chunk").alias("v"), *_NODE, "payload", F.when(F.col("near"), 1).otherwise(2).alias("side"), "distance")

    def meet(t):
        # linked documents of the region's pivot first: they are one component
        t = t.sort_by([("side", "ascending"), *((c, "ascending") for c in _NODE)])
        side = t.column("side").to_numpy()
        order = np.argsort(side != 1, kind="stable")
        nodes = [c[order] for c in _nodes(t)]
        payload = t.column("payload").to_pylist()
        n = int((side == 1).sum())
        comp = join_region(unpack([payload[k] for k in order.tolist()]), percent, targets=n)
        return _edge_table([_edges(nodes, comp)])

    cross = left.unionByName(right).groupBy("region", "u", "v").applyInArrow(meet, _EDGE)
    return star.unionByName(cross)


def components(edges: DataFrame) -> DataFrame:
    """(v, component): the smallest vertex that edges (a, b) reach, by rounds of
    minimum labels and pointer jumping; each round is written to the shared folder."""
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("w")))
    both = materialise(both.distinct(), "jaccard-edges")
    label = materialise(both.groupBy("v").agg(F.least(F.min("w"), F.col("v")).alias("label")), "jaccard-label")
    while True:
        near = both.join(label.withColumnsRenamed({"v": "w", "label": "other"}), "w").groupBy("v").agg(F.min("other").alias("other"))
        new = label.join(near, "v", "left").select("v", F.least("label", F.coalesce("other", "label")).alias("new"), "label")
        jump = new.select(F.col("v").alias("new"), F.col("new").alias("far"))
        new = new.join(jump, "new", "left").select("v", F.least("new", F.coalesce("far", "new")).alias("new"), "label")
        new = materialise(new, "jaccard-label")
        changed = new.filter(F.col("new") != F.col("label")).isEmpty()
        label = new.select("v", F.col("new").alias("label"))
        if changed:
            return label.withColumnRenamed("label", "component")


def _components_of(docs: DataFrame, gram: int, percent: int, keys: bool = False) -> DataFrame:
    """Per document: doc_id (NO_ID for null), n_shingles, class_id, component (the
    smallest node reachable by links) and, if asked for, the MD5 of its text."""
    buckets = B.bucket_count(docs)
    bands = Bands(percent)
    texts = B.text_blocks(docs)

    def sets(key, rows):
        return B.sent(key[0].as_py(), _Sets(rows, buckets, gram).rows)

    def cuts(key, rows, answer):
        return B.sent(key[0].as_py(), _Sets(rows, buckets, gram).cuts(answer, bands))

    def place(key, rows, answer):
        w = _Sets(rows, buckets, gram)
        w.cuts(answer, bands)
        doc, pivot = w.regions(answer)
        least = w.classes(answer)[0]
        sketches = {k: sketch(w.sets[k]).tobytes() for k in np.unique(doc).tolist()}
        n, m = len(w.ids), len(doc)
        row = np.concatenate([np.arange(n), doc])
        raw = w.data.tobytes() if keys else b""
        md5 = [hashlib.md5(raw[a:b]).digest() if keys else None for a, b in zip(w.offs[:-1].tolist(), w.offs[1:].tolist(), strict=True)]
        return pa.table({"block": pa.array([key[0].as_py()] * (n + m)), "row": row, "doc_id": w.ids[row], "n_shingles": w.sizes[row],
                         "id": least[row], "x": w.x.view(np.int64)[row], "y": w.y.view(np.int64)[row],
                         "region": pa.array(np.concatenate([np.zeros(n, np.int64), pivot]), mask=np.arange(n + m) < n),
                         "sketch": pa.array([None] * n + [sketches[k] for k in doc.tolist()], pa.binary()),
                         "key": pa.array(md5 + [None] * m, pa.binary())})

    def possible(rows):
        """Documents that may have a link in the region."""
        rows = rows.sort_by([("region", "ascending"), *((c, "ascending") for c in _NODE)])
        region, size = rows.column("region").to_numpy(), rows.column("n_shingles").to_numpy()
        sketches = [np.frombuffer(x, np.uint8) for x in rows.column("sketch").to_pylist()]
        keep = np.empty(len(region), bool)
        cuts_ = np.concatenate([[0], np.flatnonzero(np.diff(region)) + 1, [len(region)]])
        for lo, hi in zip(cuts_[:-1].tolist(), cuts_[1:].tolist(), strict=True):
            keep[lo:hi] = survivors(size[lo:hi], sketches[lo:hi], percent)
        return rows.select(["block", "region", "row", *_NODE]).filter(pa.array(keep))

    def send_texts(key, rows, wanted):
        _, data, offs = B.unpack(rows)
        raw = data.tobytes()
        wanted = wanted.sort_by([("region", "ascending"), ("row", "ascending")])
        row = wanted.column("row").to_pylist()
        packed = {k: B.compress(raw[offs[k]:offs[k + 1]]) for k in set(row)}
        return wanted.select(["region", *_NODE]).append_column("payload", pa.array([packed[k] for k in row], pa.binary()))

    out = "block string, row long, doc_id long, n_shingles long, id long, x long, y long, region long, sketch binary, key binary"
    heads = texts.groupBy("block").applyInArrow(sets, B.SENT).groupBy("bucket").applyInArrow(_class_heads, B.ANSWER)
    found = texts.groupBy("block").cogroup(heads.groupBy("block")).applyInArrow(cuts, B.SENT)
    pivots = found.groupBy("bucket").applyInArrow(_pivots, B.ANSWER)
    placed = materialise(texts.groupBy("block").cogroup(heads.unionByName(pivots).groupBy("block")).applyInArrow(place, out), "jaccard-placed")
    near = placed.filter(F.col("region").isNotNull()).select(
        F.pmod(F.xxhash64("region"), F.lit(buckets)).cast("int").alias("bucket"), "block", "region", "row", *_NODE, "n_shingles", "sketch")
    large = materialise(large_regions(near), "jaccard-large-regions")
    few, many = by_size(near, large)
    wanted = few.groupBy("bucket").applyInArrow(possible, _WANTED)
    if many is not None:
        wanted = materialise(wanted.unionByName(possible_in_cells(many, bands, percent)), "jaccard-wanted")
        large = materialise(chunked_regions(wanted), "jaccard-chunked-regions")
    regions = texts.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(
        send_texts, "region long, id long, x long, y long, payload binary")
    node = lambda v: F.struct(*(F.col(v + c).alias(c) for c in _NODE))
    edges = region_edges(regions, large, gram, percent, buckets).select(node("a_").alias("a"), node("b_").alias("b"))
    comp = components(edges).withColumnRenamed("v", "node")
    rows = placed.filter(F.col("region").isNull()).select("doc_id", "n_shingles", "key", node("").alias("node"))
    got = rows.join(comp, "node", "left")
    return got.select("doc_id", "n_shingles", F.col("node.id").alias("class_id"), F.coalesce("component", "node").alias("component"), "key")


def join_documents(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, class_id (smallest doc_id with an equal
    set) and component_id (smallest doc_id reachable by links)."""
    known = lambda c: F.when(F.col(c) != B.NO_ID, F.col(c))
    return _components_of(docs, gram, percent).select(known("doc_id").alias("doc_id"), "n_shingles", known("class_id").alias("class_id"),
                                                      known("component.id").alias("component_id"))


def keep_one(docs: DataFrame, gram: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the near duplicates of a document with a smaller doc_id
    in the same component; of rows that repeat a doc_id and a text, all stay or
    go.  Of a component without a doc_id one row stays."""
    got = _components_of(docs, gram, percent, keys=True)
    gone = got.filter(F.col("component.id") != F.col("doc_id")).select("doc_id", "key")
    nameless = not docs.filter(F.col("doc_id").cast("long").isNull()).isEmpty()
    if nameless:
        got = materialise(got, "jaccard-joined")
        gone = got.filter(F.col("component.id") != F.col("doc_id")).select("doc_id", "key")
        alone = got.filter((F.col("component.id") == B.NO_ID) & (F.col("n_shingles") > 0))
        first = alone.groupBy("component").agg(F.min("key").alias("first"))
        gone = gone.unionByName(alone.join(first, "component").filter(F.col("key") != F.col("first")).select("doc_id", "key"))
    gone = materialise(gone.distinct(), "jaccard-gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)  # beyond that the join shuffles
    text = F.col("text").cast("string")
    packed = docs.select(F.struct(*docs.columns).alias("whole"), F.coalesce(F.col("doc_id").cast("long"), F.lit(B.NO_ID)).alias("doc_id"),
                         F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("key"),
                         F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"))
    packed = packed.join(gone, ["doc_id", "key"], "left_anti")
    if not nameless:
        return packed.select("whole.*")
    single = (F.col("doc_id") == B.NO_ID) & F.col("worded")
    one = packed.filter(single).groupBy("key").agg(F.min_by("whole", F.xxhash64("whole")).alias("whole"))
    return packed.filter(~single).select("whole.*").unionByName(one.select("whole.*"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
