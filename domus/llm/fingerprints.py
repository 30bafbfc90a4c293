"""I-Match document fingerprints.

Terms are the lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII
characters, known by 64-bit hashes.  The lexicon holds the terms whose document
frequency, counted over all documents, lies in a band: rarer terms (spelling
errors, names) and the commonest ones carry no weight.  A fingerprint keeps a
text's distinct lexicon terms in order and hashes them through ``SUBSETS``
randomised sub-lexicons.  A sub-lexicon at level L keeps a term with the
probability 2**-L; a text is hashed at two neighbouring levels, chosen so that
about 1.5 to 3 of its terms fall into a sub-lexicon of the lower one, so texts
of any length have subsets that a small edit leaves alone.

The string is ``<level>:`` and 2 x SUBSETS hashes of 8 hex digits (``-`` where a
sub-lexicon keeps none of the terms); the likeness of two fingerprints is the
share of equal hashes at the levels both have, without those empty in both.
A text without lexicon terms has ``t:`` and a hash of the text, like only to
itself.  Equal texts have equal fingerprints.

Documents are dealt to parts by ranges of doc_id; every part also gets the first
document of the next one, so a document meets its successor (for the last one
the first document).  Null texts count as empty; null doc_ids come first; rows
that repeat a doc_id are ordered by the hash of their text, then the text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.llm import blocks as B
from domus.llm.common import ALNUM_WORDS, LOWER, SLICE_BYTES, gram_hashes, id_and_text, materialise, mix64, slices, table, word_hashes, word_spans
from domus.llm.ranges import Ranges, id_hash_text, text_ranges

LEAST_SHARE = 0.001  # of all documents that hold a term of the lexicon
MOST_SHARE = 0.5
SUBSETS = 16
COUNT_BYTES = 16 << 20  # text whose document frequencies are added up before they are sent
LEXICON_TERMS = 1 << 23  # largest lexicon sent to the tasks (64 MB)


# ------------------------------------------------------------ lexicon
def document_terms(data: np.ndarray, offs: np.ndarray) -> tuple:
    """(document, term) of the distinct terms of every document, in order."""
    data = LOWER[data]
    starts, ends, by_doc = word_spans(data, offs, ALNUM_WORDS)
    terms = word_hashes(data, starts, ends)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(by_doc))
    order = np.lexsort((terms, doc))
    terms, doc = terms[order], doc[order]
    new = np.ones(len(terms), bool)
    new[1:] = (terms[1:] != terms[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], terms[new]


def document_frequencies(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, blob): distinct terms and the documents that hold them, per stretch of documents."""
    def run(batches):
        held, size = [], 0

        def cut():
            terms, counts = np.unique(np.concatenate(held), return_counts=True)
            own = B.bucket_of(terms, buckets)
            order = np.argsort(own, kind="stable")
            rows = [(k, terms[order][lo:hi].tobytes() + counts[order][lo:hi].astype(np.int64).tobytes()) for k, lo, hi in B.by_bucket(own[order])]
            return B.sent("", rows).to_batches()

        for b in batches:
            for _, _, data, offs in slices(b, "text"):
                held.append(document_terms(data, offs)[1])
                size += len(data)
                if size >= COUNT_BYTES:
                    yield from cut()
                    held, size = [], 0
        if held:
            yield from cut()

    return id_and_text(docs).select("text").mapInArrow(run, B.SENT)


def lexicon(docs: DataFrame, n_docs: int, buckets: int, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """Terms that ``least`` to ``most`` of all documents hold.  There are at most
    (mean number of distinct terms of a document) / ``least`` of them, however
    many documents there are."""
    low, high = max(1, int(np.ceil(least * n_docs))), max(1, int(most * n_docs))

    def add(rows):
        parts = [(np.frombuffer(x, np.uint64, len(x) // 16), np.frombuffer(x, np.int64, len(x) // 16, len(x) // 2)) for x in rows.column("blob").to_pylist()]
        terms, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        n = np.bincount(at, np.concatenate([p[1] for p in parts]), len(terms))
        return pa.table({"term": terms[(n >= low) & (n <= high)].view(np.int64)})

    return document_frequencies(docs, buckets).groupBy("bucket").applyInArrow(add, "term long")


def lexicon_array(terms: DataFrame, limit: int = LEXICON_TERMS) -> np.ndarray:
    """The lexicon for the tasks, its size checked first."""
    terms = materialise(terms, "lexicon")
    n = terms.count()
    if n > limit:
        raise ValueError(f"{n} terms in the band, {limit} at most; raise the least share of documents that hold a term")
    return np.sort(terms.toArrow().column("term").to_numpy().view(np.uint64))


# ------------------------------------------------------------ fingerprints
def _salts(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def subset_hashes(doc: np.ndarray, terms: np.ndarray, n: int, subsets: int = SUBSETS) -> tuple:
    """(level, hashes) of n texts from their ordered distinct lexicon terms:
    hashes is n x 2 x subsets, 0 for an empty subset; level -1 without terms."""
    size = np.bincount(doc, minlength=n)
    level = np.where(size > 0, np.ceil(np.log2(np.maximum(size, 1) / 3)).clip(0), -1).astype(np.int64)
    out = np.zeros((n, 2, subsets), np.uint32)
    for s, salt in enumerate(_salts(subsets).tolist()):
        place = mix64(terms ^ np.uint64(salt))
        for up in (0, 1):
            own = np.flatnonzero(place <= np.uint64(2 ** 64 - 1) >> (np.maximum(level, 0)[doc] + up).astype(np.uint64))
            if not len(own):
                continue
            kept = doc[own]
            first = np.flatnonzero(np.concatenate([[True], kept[1:] != kept[:-1]]))
            h = gram_hashes(terms[own], first, np.append(first[1:], len(own)))
            out[kept[first], up, s] = (h >> np.uint64(33)).astype(np.uint32) + np.uint32(1)
    return level, out


def fingerprints(texts: list, lex: np.ndarray, subsets: int = SUBSETS) -> tuple:
    """(level, hashes) of UTF-8 texts."""
    levels, parts = [], []
    batch = pa.record_batch({"text": pa.array(texts, pa.large_binary())})
    for _, n, data, offs in slices(batch, "text"):
        doc, terms = document_terms(data, offs)
        known = np.zeros(len(terms), bool)
        if len(lex):
            known = lex[np.minimum(np.searchsorted(lex, terms), len(lex) - 1)] == terms
        level, hashes = subset_hashes(doc[known], terms[known], n, subsets)
        levels.append(level)
        parts.append(hashes)
    if not parts:
        return np.zeros(0, np.int64), np.zeros((0, 2, subsets), np.uint32)
    return np.concatenate(levels), np.concatenate(parts)


def likeness(a: tuple, b: tuple, same: np.ndarray) -> np.ndarray:
    """Likeness of the fingerprints row by row; ``same`` where the texts are
    equal, which counts for those without terms."""
    (la, ha), (lb, hb) = a, b
    equal, seen = np.zeros(len(la), np.int64), np.zeros(len(la), np.int64)
    for up in (0, 1):
        for other in (0, 1):
            both = (la >= 0) & (lb >= 0) & (la + up == lb + other)
            x, y = ha[:, up], hb[:, other]
            some = ((x > 0) | (y > 0)) & both[:, None]
            equal += (some & (x == y)).sum(axis=1)
            seen += some.sum(axis=1)
    out = np.divide(equal, seen, out=np.zeros(len(la)), where=seen > 0)
    return np.where((la < 0) & (lb < 0), same.astype(np.float64), out)


def as_strings(texts: list, prints: tuple) -> list:
    out = []
    for text, level, hashes in zip(texts, prints[0].tolist(), prints[1], strict=True):
        if level < 0:
            out.append("t:" + hashlib.sha256(text).hexdigest()[:32])
        else:
            out.append(f"{level}:" + "".join(f"{x:08x}" if x else "-" for x in hashes.ravel().tolist()))
    return out


# ------------------------------------------------------------ successors
def edited(own: str, following: str) -> str:
    """The last quarter of the characters replaced by the first as many of the next text."""
    n = len(own) // 4
    return own[:len(own) - n] + following[:n]


def first_of_parts(keyed: DataFrame, ranges: Ranges) -> list:
    """(part, key, h) of the first document of every part that has one."""
    def run(batches):
        for b in batches:
            key, h = b.column("key").to_numpy(), b.column("h").to_numpy()
            if len(key):
                part = ranges.part_of(key, h)
                order = np.lexsort((h, key, part))
                at = order[np.concatenate([[True], np.diff(part[order]) > 0])]
                yield pa.RecordBatch.from_arrays([pa.array(part[at], pa.int32()), pa.array(key[at]), pa.array(h[at])], names=["part", "key", "h"])

    heads = keyed.select("key", "h").mapInArrow(run, "part int, key long, h long").groupBy("part").agg(F.min(F.struct("key", "h")).alias("head"))
    return sorted((r["part"], r["head"]["key"], r["head"]["h"]) for r in heads.collect())  # one row a part


def part_texts(keyed: DataFrame, ranges: Ranges) -> DataFrame:
    """(part, payload columns): the documents of every part, and once more the
    documents that follow it, as compressed stretches."""
    heads = first_of_parts(keyed, ranges)
    follows = {}  # (key, h) -> the parts that it follows
    for (part, _, _), (_, key, h) in zip(heads, [*heads[1:], *heads[:1]], strict=True):
        follows.setdefault((key, h), []).append(part)
    keys = np.array(sorted({k for k, _ in follows}), np.int64)

    def run(batches):
        held, size = {}, 0

        def cut():
            for (part, after), rows in sorted(held.items()):
                key, h, null, text = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([after]), pa.array([np.array(key, np.int64).tobytes()], pa.binary()),
                     pa.array([np.array(h, np.int64).tobytes()], pa.binary()), pa.array([np.array(null, np.bool_).tobytes()], pa.binary()),
                     pa.array([np.array([len(t) for t in text], np.int64).tobytes()], pa.binary()), pa.array([B.compress(b"".join(text))], pa.binary())],
                    names=["part", "after", "keys", "hashes", "nulls", "sizes", "payload"])

        for b in batches:
            key, h = b.column("key").to_numpy(), b.column("h").to_numpy()
            part = ranges.part_of(key, h).tolist()
            may = np.isin(key, keys).tolist()
            null = b.column("doc_id").is_null().to_pylist()
            text = b.column("text").cast(pa.large_binary())
            for i, (k, x) in enumerate(zip(key.tolist(), h.tolist(), strict=True)):
                row = (k, x, null[i], text[i].as_py() or b"")
                held.setdefault((part[i], False), []).append(row)
                size += len(row[3]) + 64
                for p in follows.get((k, x), []) if may[i] else []:
                    after = held.setdefault((p, True), [])
                    if row not in after:  # repeated rows follow once
                        after.append(row)
                if size >= COUNT_BYTES:
                    yield from cut()
                    held, size = {}, 0
        yield from cut()

    return keyed.mapInArrow(run, "part int, after boolean, keys binary, hashes binary, nulls binary, sizes binary, payload binary")


def _rows_of(stretches: list) -> list:
    """(key, h, text, null) of all documents of the stretches, in order."""
    out = []
    for r in stretches:
        sizes = np.frombuffer(r["sizes"], np.int64)
        ends = np.cumsum(sizes)
        raw = B.decompress(r["payload"])
        texts = [raw[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
        out += zip(np.frombuffer(r["keys"], np.int64).tolist(), np.frombuffer(r["hashes"], np.int64).tolist(), texts,
                   np.frombuffer(r["nulls"], np.bool_).tolist(), strict=True)
    return sorted(out)


def fingerprint_documents(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE, subsets: int = SUBSETS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every document."""
    ranges = text_ranges(docs)
    lex = lexicon_array(lexicon(docs, ranges.n_docs, ranges.parts, least, most))
    lex = docs.sparkSession.sparkContext.broadcast(lex)
    fields = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def work(rows):
        rows = rows.to_pylist()
        own = _rows_of([r for r in rows if not r["after"]])
        nexts = [r[2] for r in own[1:]] + [_rows_of([r for r in rows if r["after"]])[0][2]]
        out, lo = [], 0
        while lo < len(own):
            hi, size = lo, 0
            while hi < len(own) and (hi == lo or size < 4 * SLICE_BYTES):
                size += len(own[hi][2])
                hi += 1
            texts = [r[2] for r in own[lo:hi]]
            chars = [t.decode("utf-8", "surrogatepass") for t in texts]
            last = nexts[hi - 1]
            new = [edited(a, b).encode("utf-8", "surrogatepass")
                   for a, b in zip(chars, [*chars[1:], last.decode("utf-8", "surrogatepass")], strict=True)]
            prints, new_prints = fingerprints([*texts, last], lex.value, subsets), fingerprints(new, lex.value, subsets)
            mine = tuple(x[:-1] for x in prints)
            after = tuple(x[1:] for x in prints)
            ids = np.array([r[0] for r in own[lo:hi]], np.int64)
            out.append(pa.table({
                "doc_id": pa.array(ids, pa.int64(), mask=np.array([r[3] for r in own[lo:hi]], bool)), "n_chars": pa.array([len(c) for c in chars], pa.int64()),
                "edited_sha256": [hashlib.sha256(t).hexdigest() for t in new], "fingerprint": as_strings(texts, mine),
                "edited_fingerprint": as_strings(new, new_prints),
                "near_edited": likeness(mine, new_prints, np.array([a == b for a, b in zip(texts, new, strict=True)])),
                "near_next": likeness(mine, after, np.array([a == b for a, b in zip(texts, nexts[lo:hi], strict=True)]))}))
            lo = hi
        return pa.concat_tables(out)

    return part_texts(id_hash_text(docs), ranges).groupBy("part").applyInArrow(work, fields)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
