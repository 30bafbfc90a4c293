"""BPE encoding and decoding through a table of distinct words.

Texts are split at ASCII white space, which the tokenizer drops and across
which none of its steps looks (normalisation composes no character with white
space, the split pattern never matches it).  Documents form blocks; a block
holds its distinct words once and every document as positions in that list.
The words of all blocks meet in buckets by their hash, packed, so a word
reaches its bucket once per block however frequent it is; there each distinct
word is encoded once, and its ids go back to the blocks, where they join the
documents by position.  Decoding maps ids to pieces by the vocabulary (bounded
by the tokenizer file) and joins pieces as the library does.

Null texts count as empty (no ids, empty string).  Repeated rows and doc_ids
each give a row.  Blocks are cut by size in the order of the scan; a block is
known by the hash of its documents and words, and a block whose words did not
come back raises an error instead of giving wrong rows.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from domus.llm import blocks as B
from domus.llm.common import give_back, id_and_text, table, word_hashes
from domus.llm.tokens import load_tokenizer, tokenizer_path

BLOCK_BYTES = 6 << 20  # text of a block: bounds the memory of every task


class _Numbering(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def _blocks(batches, limit: int):
    """Yield (block, words, doc_ids, word counts, positions) per block of documents."""
    words, ids, packed, size = _Numbering(), [], [], 0

    def cut():
        own = np.array(ids, np.int64)
        counts = np.array([len(p) for p in packed], np.int64)
        at = np.concatenate(packed) if packed else np.zeros(0, np.uint32)
        h = hashlib.blake2b(b"\n".join(words), digest_size=12)
        for x in (own, counts, at):
            h.update(x.tobytes())
        return h.hexdigest(), list(words), own, counts, at

    for b in batches:
        for i, t in zip(b.column("doc_id").fill_null(B.NO_ID).to_pylist(), b.column("text").cast(pa.large_binary()), strict=True):
            raw = t.as_py() or b""
            own = raw.split()
            ids.append(i)
            packed.append(np.fromiter(map(words.__getitem__, own), np.uint32, len(own)))
            size += len(raw) + 64
            if size >= limit:
                yield cut()
                words, ids, packed, size = _Numbering(), [], [], 0
    if ids:
        yield cut()


def word_buckets(words: list, buckets: int):
    """(bucket per word in bucket order, the order): a word's bucket is by its bytes."""
    size = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(size)
    bucket = B.bucket_of(word_hashes(np.frombuffer(b"".join(words), np.uint8), ends - size, ends), buckets)
    order = np.argsort(bucket, kind="stable")
    return bucket[order], order


def block_words(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, blob): the distinct words of every block, packed by bucket."""
    limit = BLOCK_BYTES

    def run(batches):
        for key, words, _, _, _ in _blocks(batches, limit):
            bucket, order = word_buckets(words, buckets)
            rows = [(k, B.compress(b"\n".join([words[i] for i in order[lo:hi].tolist()]))) for k, lo, hi in B.by_bucket(bucket)]
            yield from B.sent(key, rows).to_batches()

    return id_and_text(docs).mapInArrow(run, B.SENT)


def block_documents(docs: DataFrame, buckets: int) -> DataFrame:
    """(block, ids, counts, positions, place): a block's documents as positions
    in its words; ``place`` has the words' numbers in the order the buckets return them."""
    limit = BLOCK_BYTES

    def run(batches):
        for key, words, ids, counts, at in _blocks(batches, limit):
            _, order = word_buckets(words, buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key]), *(pa.array([B.compress(x.tobytes())], pa.binary()) for x in (ids, counts, at, order.astype(np.uint32)))],
                names=["block", "ids", "counts", "positions", "place"])

    return id_and_text(docs).mapInArrow(run, "block string, ids binary, counts binary, positions binary, place binary")


def encode_words(words: DataFrame, path: str) -> DataFrame:
    """(block, bucket, stage, bits): for every block's words of a bucket the
    number of ids of each and the ids, packed; a distinct word is encoded once."""
    def run(rows):
        give_back()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        lib = load_tokenizer(path)
        lists = [B.decompress(x).split(b"\n") for x in rows.column("blob").to_pylist()]
        distinct = sorted(set().union(*lists))
        codes: dict = {}
        for lo in range(0, len(distinct), 20_000):
            part = distinct[lo:lo + 20_000]
            got = lib.encode_batch_fast([w.decode("utf-8", "replace") for w in part], add_special_tokens=False)
            codes.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(part, got, strict=True))
        out = []
        for words in lists:
            ids = [codes[w] for w in words]
            out.append(B.compress(np.array([len(ids), *(len(x) // 4 for x in ids)], "<u4").tobytes() + b"".join(ids)))
        return B.answers(rows, 1, out)

    return words.groupBy("bucket").applyInArrow(run, B.ANSWER)


def encode_decode(docs: DataFrame, path: str, digest: bool = True) -> DataFrame:
    """Per document: doc_id, n_tokens and either the digests (ids_sha256,
    decoded_sha256) or ids array<int> and decoded string."""
    lib = load_tokenizer(path)
    names = {i: p for p, i in lib.get_vocab(with_added_tokens=True).items()}
    pieces = docs.sparkSession.sparkContext.broadcast([names.get(i, "") for i in range(max(names) + 1)])
    buckets = B.bucket_count(docs)
    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else \
        "doc_id long, n_tokens long, ids array<int>, decoded string"

    def join(key, left, right):
        give_back()  # of the block before
        piece = pieces.value
        counts, codes = [], []
        for r in sorted(right.to_pylist(), key=lambda r: r["bucket"]):
            x = np.frombuffer(B.decompress(r["bits"]), "<u4")
            counts.append(x[1:1 + int(x[0])])
            codes.append(x[1 + int(x[0]):])
        count = np.concatenate(counts).astype(np.int64) if counts else np.zeros(0, np.int64)
        flat = (np.concatenate(codes) if codes else np.zeros(0, np.uint32)).tolist()
        doc_ids, totals, ones, twos = [], [], [], []
        for row in left.to_pylist():
            ids, lens, at, place = (np.frombuffer(B.decompress(row[c]), t) for c, t in (
                ("ids", np.int64), ("counts", np.int64), ("positions", np.uint32), ("place", np.uint32)))
            if len(place) != len(count):
                raise ValueError("a block's words are not those its documents were written with")
            # by the word's number in the block
            n, numbers, decoded, own = np.zeros(len(place), np.int64), [b""] * len(place), [b""] * len(place), [[]] * len(place)
            n[place] = count
            ends = np.cumsum(count)
            for w, lo, hi in zip(place.tolist(), (ends - count).tolist(), ends.tolist(), strict=True):
                x = flat[lo:hi]
                decoded[w] = " ".join([piece[i] for i in x]).encode()
                if digest:
                    numbers[w] = b"%d" % x[0] if hi - lo == 1 else b" ".join([b"%d" % i for i in x])
                else:
                    own[w] = x
            silent = not n.all()
            stop = np.cumsum(lens)
            for i, lo, hi in zip(ids.tolist(), (stop - lens).tolist(), stop.tolist(), strict=True):
                pos = at[lo:hi]
                seen = (pos[n[pos] > 0] if silent else pos).tolist()  # words without ids leave no piece
                text = b" ".join(map(decoded.__getitem__, seen))
                doc_ids.append(None if i == B.NO_ID else i)
                totals.append(int(n[pos].sum()))
                if digest:
                    ones.append(hashlib.sha256(b" ".join(map(numbers.__getitem__, seen))).hexdigest())
                    twos.append(hashlib.sha256(text).hexdigest())
                else:
                    ones.append([x for w in seen for x in own[w]])
                    twos.append(text.decode())
        kinds = [pa.int64(), pa.int64(), *([pa.string(), pa.string()] if digest else [pa.list_(pa.int32()), pa.string()])]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip((doc_ids, totals, ones, twos), kinds, strict=True)],
                                    names=[f.split()[0] for f in fields.split(", ")])

    words = encode_words(block_words(docs, buckets), path)
    return block_documents(docs, buckets).groupBy("block").cogroup(words.groupBy("block")).applyInArrow(join, fields)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
