"""Phrase collocations from mergeable Misra-Gries summaries.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and the
pieces into words (runs of anything but space and tab).  A phrase is 1 to
``MAX_WORDS`` consecutive words of one piece, within one language (null:
``und``).

First pass: the texts form blocks; a block sends its phrases as counted hash
classes (``CLASS_BITS`` bits in a hash partition, delta coded), each distinct
one once.  A partition folds them into one Misra-Gries summary with more
counters than its mass divided by the threshold, so what was taken off a
counter stays below the threshold and every frequent phrase survives; a class
whose counter plus what was taken off cannot reach the threshold is dropped.
Second pass: the blocks are told which of their classes survived, count exactly
the phrases in those, and the partitions add up the counts by the phrase
itself.  Phrases below the threshold that shared a surviving class go here, so
the counts are exact.  Scores and the removal of phrases inside longer ones are
joins over the frequent phrases.

Null or empty texts and texts without a word add nothing; repeated rows count
as often as they stand there; all columns but ``text`` and ``lang`` are ignored.
A very long text is cut between pieces, a piece never.  An empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from domus.llm import blocks as B
from domus.llm.common import LOWER, give_back, gram_hashes, materialise, mix64, table, within_ranges, word_hashes, word_spans

MAX_WORDS = 4
THRESHOLD = 30
ABSORBED = 80  # percent of a phrase's occurrences inside one longer phrase
TOP = 2000
SCALE = 2_000_000
CLASS_BITS = 26
BLOCK_BYTES = 4 << 20
CUT_BYTES = 1 << 20  # longer texts are cut between pieces
MERGE_ROWS = 1 << 21  # entries folded into a summary at a time

_SPACE, _BREAK = 0x20, 0x0A
_MAP = LOWER.copy()
_MAP[0x09] = _SPACE
_MAP[list(b".,;:!?\x0A\x0B\x0C\x0D")] = _BREAK
_WORD = np.ones(256, bool)
_WORD[[_SPACE, _BREAK]] = False


# ------------------------------------------------------------ texts and blocks
def normal_form(text: bytes) -> np.ndarray:
    """Bytes of the text: lower case, pieces end in a line feed, words of a
    piece are one space apart."""
    x = _MAP[np.frombuffer(text, np.uint8)]
    x = np.append(x, np.uint8(_BREAK))
    space, cut = x == _SPACE, x == _BREAK
    before = np.concatenate([[_BREAK], x[:-1]])
    after = np.append(x[1:], np.uint8(_BREAK))
    return x[~(space & ((before == _SPACE) | (before == _BREAK) | (after == _BREAK))) & ~(cut & (before == _BREAK))]


def cut_pieces(x: np.ndarray, limit: int):
    """Stretches of about ``limit`` bytes that end where a piece does."""
    ends = np.flatnonzero(x == _BREAK) + 1
    lo = 0
    while lo < len(x):
        hi = int(ends[min(np.searchsorted(ends, lo + limit), len(ends) - 1)])
        yield x[lo:hi]
        lo = hi


def phrase_blocks(docs: DataFrame, limit: int = BLOCK_BYTES) -> DataFrame:
    """(block, langs, payload): the texts of a block in normal form, joined by
    language; ``langs`` lists [lang, bytes]."""
    def run(batches):
        task, number, size, parts = TaskContext.get().partitionId(), 0, 0, {}

        def cut():
            langs = sorted(parts)
            joined = [np.concatenate(parts[k]) for k in langs]
            head = json.dumps([[k, len(x)] for k, x in zip(langs, joined, strict=True)])
            raw = np.concatenate(joined).tobytes()
            h = hashlib.blake2b(f"{task} {number} {head}".encode(), digest_size=12)
            h.update(raw)
            return pa.RecordBatch.from_arrays([pa.array([h.hexdigest()]), pa.array([head]), pa.array([B.compress(raw)], pa.binary())],
                                              names=["block", "langs", "payload"])

        for b in batches:
            for lang, text in zip(b.column("lang"), b.column("text").cast(pa.large_binary()), strict=True):
                raw = text.as_py()
                if not raw:
                    continue
                for x in cut_pieces(normal_form(raw), CUT_BYTES):
                    parts.setdefault(lang.as_py(), []).append(x)
                    size += len(x) + 64
                    if size >= limit:
                        yield cut()
                        number, size, parts = number + 1, 0, {}
        if parts:
            yield cut()

    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "block string, langs string, payload binary")


class _Phrases:
    """The phrases of a block: for every length the starts (word numbers) and
    the class of each occurrence."""

    def __init__(self, rows: pa.Table, buckets: int):
        give_back()  # of the block before
        row = rows.slice(0, 1).to_pylist()[0]
        self.times = len(rows)  # equal blocks
        self.langs, sizes = zip(*json.loads(row["langs"]), strict=True)
        self.data = np.frombuffer(B.decompress(row["payload"]), np.uint8)
        self.starts, self.ends, self.by_lang = word_spans(self.data, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), _WORD)
        self.lang = np.repeat(np.arange(len(self.langs)), np.diff(self.by_lang))
        salts = [int.from_bytes(hashlib.blake2b(k.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for k in self.langs]
        self.salt = np.array(salts, np.uint64)[self.lang]
        self.words = self.word_hashes(0)
        # words of one piece stand one byte apart
        joined = np.append(self.data, np.uint8(_BREAK))[self.ends] == _SPACE
        self.first = []
        at = np.arange(len(self.starts))
        for n in range(1, MAX_WORDS + 1):
            self.first.append(at)
            at = at[joined[at + n - 1]]
        self.classes = [self.class_of(n, buckets) for n in range(1, MAX_WORDS + 1)]

    def word_hashes(self, which: int) -> np.ndarray:
        """Hashes of the words, a stretch of about ``CUT_BYTES`` at a time."""
        cuts = np.unique(np.r_[0, np.searchsorted(self.starts, np.arange(CUT_BYTES, len(self.data), CUT_BYTES)), len(self.starts)])
        out = [np.zeros(0, np.uint64)]
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            at = int(self.starts[lo])
            out.append(word_hashes(self.data[at:self.ends[hi - 1]], self.starts[lo:hi] - at, self.ends[lo:hi] - at, which))
        return np.concatenate(out)

    def class_of(self, n: int, buckets: int) -> np.ndarray:
        at = self.first[n - 1]
        g = mix64(gram_hashes(self.words, at, at + n) ^ self.salt[at])
        bucket = (g >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        return (bucket << np.uint64(CLASS_BITS)) | (g & np.uint64((1 << CLASS_BITS) - 1))

    def distinct(self) -> tuple:
        """(classes in order, counts)."""
        keys, counts = np.unique(np.concatenate(self.classes), return_counts=True)
        return keys, counts * self.times

    def exact(self, keys: np.ndarray) -> pa.Table:
        """(key, lang, phrase, words, n) of the phrases in the given classes."""
        out = []
        second = self.word_hashes(1)
        for n in range(1, MAX_WORDS + 1):
            own = np.flatnonzero(is_in(self.classes[n - 1], keys))
            key, at = self.classes[n - 1][own], self.first[n - 1][own]
            prints = [gram_hashes(x, at, at + n, k) for k, x in enumerate((self.words, second))]
            order = np.lexsort((prints[1], prints[0], self.lang[at], key))
            new = np.zeros(len(order), bool)
            new[:1] = True
            for c in (key, self.lang[at], *prints):
                new[1:] |= c[order][1:] != c[order][:-1]
            head = np.flatnonzero(new)
            some = order[head]  # an occurrence of every phrase
            lo, hi = self.starts[at[some]], self.ends[at[some] + n - 1]
            out.append(pa.table({"key": pa.array(key[some].astype(np.int64)), "lang": pa.array([self.langs[i] for i in self.lang[at[some]].tolist()], pa.string()),
                                 "phrase": gather(self.data, lo, hi), "words": pa.array(np.full(len(some), n, np.int32)),
                                 "n": pa.array(np.diff(np.append(head, len(order))) * self.times)}))
        return pa.concat_tables(out)

    def totals(self) -> pa.Table:
        n = np.diff(self.by_lang) * self.times
        return pa.table({"lang": pa.array(self.langs, pa.string()), "phrase": pa.array([""] * len(n)),
                         "words": pa.array(np.zeros(len(n), np.int32)), "n": pa.array(n)})


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The strings data[start:end]."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data[within_ranges(starts, size)])])


def is_in(x: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(x), bool)
    return keys[np.minimum(np.searchsorted(keys, x), len(keys) - 1)] == x


# ------------------------------------------------------------ summaries
def pack_counts(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """The mass (uncompressed), then sorted classes and counts: differences by byte plane, compressed."""
    gaps = np.diff(keys, prepend=keys[:1] * 0).astype("<u4")
    planes = counts.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() + gaps.view(np.uint8).reshape(-1, 4).T.tobytes()
    return np.array([counts.sum(), len(keys)], "<i8").tobytes() + B.compress(planes)


def unpack_counts(blob: bytes) -> tuple:
    n = int(np.frombuffer(blob, "<i8", 1, 8)[0])
    raw = B.decompress(blob[16:])
    counts = np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n).T.copy().view("<i8").ravel()
    gaps = np.frombuffer(raw, np.uint8, 4 * n, 8 * n).reshape(4, n).T.copy().view("<u4").ravel()
    return np.cumsum(gaps, dtype=np.uint64), counts


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple:
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[start], np.add.reduceat(counts[order], start)


def misra_gries(summary: tuple, keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple:
    """Merge counted keys into a summary (keys, counters, taken off): above
    ``capacity`` counters, the largest one that must go is taken off all."""
    have, counters, lost = summary
    k, c = add_up(np.concatenate([have, keys]), np.concatenate([counters, counts]))
    if len(k) > capacity:
        cut = int(np.partition(c, len(c) - capacity - 1)[len(c) - capacity - 1])
        keep = c > cut
        k, c, lost = k[keep], c[keep] - cut, lost + cut
    return k, c, lost


def summarise(blobs: list, threshold: int) -> np.ndarray:
    """Classes that may hold ``threshold`` occurrences, from packed counts."""
    mass = sum(int(np.frombuffer(x, "<i8", 1)[0]) for x in blobs)
    summary = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    held, rows = [], 0
    for i, blob in enumerate(blobs):
        held.append(unpack_counts(blob))
        rows += len(held[-1][0])
        if rows >= MERGE_ROWS or i == len(blobs) - 1:
            summary = misra_gries(summary, *(np.concatenate(x) for x in zip(*held, strict=True)), mass // threshold + 1)
            held, rows = [], 0
    keys, counters, lost = summary
    return keys[counters + lost >= threshold]


# ------------------------------------------------------------ the operator
def as_blob(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as w:
        w.write_table(t.combine_chunks())
    return B.compress(sink.getvalue().to_pybytes())


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(lang, phrase, words, n): every phrase of up to MAX_WORDS words with at
    least ``threshold`` occurrences, and for every lang a row with words = 0
    and the number of all its words."""
    buckets = B.bucket_count(docs)
    texts = phrase_blocks(docs)

    def send(key, rows):
        keys, counts = _Phrases(rows, buckets).distinct()
        own = (keys >> np.uint64(CLASS_BITS)).astype(np.int64)
        low = keys & np.uint64((1 << CLASS_BITS) - 1)
        return B.sent(key[0].as_py(), [(k, pack_counts(low[lo:hi], counts[lo:hi])) for k, lo, hi in B.by_bucket(own)])

    def survivors(rows):
        blobs = rows.column("blob").to_pylist()
        alive = summarise(blobs, threshold)
        return B.answers(rows, 1, [np.packbits(is_in(unpack_counts(x)[0], alive)).tobytes() for x in blobs])

    def count(key, rows, answer):
        p = _Phrases(rows, buckets)
        keys, _ = p.distinct()
        own = (keys >> np.uint64(CLASS_BITS)).astype(np.int64)
        alive = keys[B.read_bits(answer, 1, [(k, hi - lo) for k, lo, hi in B.by_bucket(own)])]
        found = p.exact(alive)
        at = found.column("key").to_numpy() >> CLASS_BITS
        order = np.argsort(at, kind="stable")
        found = found.drop(["key"]).take(order)
        out = [(k, as_blob(found.slice(lo, hi - lo))) for k, lo, hi in B.by_bucket(at[order])]
        return B.sent(key[0].as_py(), [*out, (buckets, as_blob(p.totals()))])

    def total(rows):
        t = pa.concat_tables([pa.ipc.open_stream(B.decompress(x)).read_all() for x in rows.column("blob").to_pylist()])
        t = t.group_by(["lang", "phrase", "words"]).aggregate([("n", "sum")])
        n, words = t.column("n_sum").to_numpy(), t.column("words").to_numpy()
        t = t.filter(pa.array((n >= threshold) | (words == 0)))
        return t.select(["lang", "phrase", "words", "n_sum"]).rename_columns(["lang", "phrase", "words", "n"])

    flags = texts.groupBy("block").applyInArrow(send, B.SENT).groupBy("bucket").applyInArrow(survivors, B.ANSWER)
    counted = texts.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(count, B.SENT)
    return counted.groupBy("bucket").applyInArrow(total, "lang string, phrase string, words int, n long")


def score_phrases(frequent: DataFrame, scale: int = SCALE) -> DataFrame:
    """(lang, phrase, words, a, l, r, score): every phrase of two words or more
    with its lowest-scoring cut."""
    cand = frequent.where("words >= 2").select("lang", "phrase", "words", F.col("n").alias("a"))
    part = F.split("phrase", " ", -1)
    cuts = cand.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("left_part", F.array_join(F.slice(part, F.lit(1), F.col("k")), " "))
    cuts = cuts.withColumn("right_part", F.array_join(F.slice(part, F.col("k") + 1, F.col("words") - F.col("k")), " "))
    # parts of a frequent phrase are frequent, so the joins lose nothing
    known = frequent.where("words >= 1")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left_part"), F.col("n").alias("l")), ["lang", "left_part"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right_part"), F.col("n").alias("r")), ["lang", "right_part"])
    exact = F.expr(f"cast(a as decimal(19, 0)) * {scale} div (cast(l as decimal(19, 0)) + r)")
    cuts = cuts.withColumn("score", exact)
    low = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return low.select("lang", "phrase", "words", "a", "m.l", "m.r", "m.score")


def drop_absorbed(scored: DataFrame, percent: int = ABSORBED) -> DataFrame:
    """Without the phrases that stand inside a longer one with at least
    ``percent`` of their occurrences."""
    part = F.split("phrase", " ", -1)
    inner = scored.where("words >= 3").select("lang", "words", "a", part.alias("w"))
    inner = inner.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inner = inner.groupBy("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left")
    return kept.where(f"longer is null or cast(longer as decimal(19, 0)) * 100 < cast(a as decimal(19, 0)) * {percent}").drop("longer")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each lang's first ``top`` phrases
    by score, a (both descending) and phrase."""
    frequent = materialise(frequent_phrases(docs, threshold), "phrases")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = drop_absorbed(score_phrases(frequent)).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    words = frequent.where("words = 0").select("lang", "n")
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


_GRAMS = "\nUNION ALL\n".join(
    f"SELECT lang, {n} AS words, " + " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
    + f" AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {n - 2})) AS i FROM words WHERE len(w) >= {n})"
    for n in range(1, MAX_WORDS + 1))

ORACLE = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\\x20\\x09]+') IF x <> ''] AS w FROM pieces
), total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), freq AS (
  SELECT lang, words, phrase, count(*) AS f FROM ({_GRAMS}) GROUP BY ALL HAVING count(*) >= {THRESHOLD}
), cand AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM freq WHERE words >= 2
), cuts AS (SELECT *, unnest(range(1, words)) AS k FROM cand
), scored AS (
  SELECT c.lang, c.phrase, c.words, c.a, c.k, x.f AS l, y.f AS r,
         CAST(CAST({SCALE} AS HUGEINT) * c.a // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cuts c JOIN freq x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.k], ' ')
              JOIN freq y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), low AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ins AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, words - s + 2)) AS i FROM (SELECT *, unnest(range(2, words)) AS s FROM cand WHERE words >= 3))
  GROUP BY ALL
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT low.lang, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM low LEFT JOIN ins USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {ABSORBED} * a
) JOIN total USING (lang) WHERE rank <= {TOP}
"""
