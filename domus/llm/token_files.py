"""Token-ID files: flat unsigned integers plus 64-bit document offsets.

``write_token_files`` encodes every text, appends the end id, deals documents
to partitions by ranges of doc_id (their number follows the text's size) and
writes, per partition, ``<name>.bin`` (ids, little-endian unsigned 16 bit where
the vocabulary allows it, else 32 bit), ``<name>.idx`` (unsigned 64-bit offsets
into the .bin file, one more than documents) and ``<name>.doc`` (signed 64-bit
doc_ids).  The manifest (a Parquet table beside the files) lists the files of
the tasks that succeeded; a repeated task writes under a new name, so nothing
half-written is ever read.  Partition bases are prefix sums over the manifest.
``read_token_files`` memory-maps the files again.

Null texts count as empty; null doc_ids sort first; rows that repeat a doc_id
each keep a document of their own (neighbours, in the order of their texts' hashes).
"""

from __future__ import annotations

import functools
import itertools
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from domus.llm.common import shared_dir, table, within_ranges
from domus.llm.ranges import Ranges, id_hash_text, text_ranges
from domus.llm.tokens import load_tokenizer, tokenizer_path

CACHE_WORDS = 700_000
#: two white-space characters in a row; fixed values: the white-space characters of Unicode and the separators 1C to 1F
DOUBLE_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}"
FILE_TEXT_BYTES = 32 << 20  # text of a file


class _Numbering(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


class WordEncoder:
    """Byte-level BPE of whole texts.  The pre-tokenizer never joins characters
    across a single space, so a text without two white-space characters in a row
    is the concatenation of its space-led words; any other text goes through the
    library whole.  Words are numbered, and the library encodes each once while
    it is remembered: above ``limit`` words those met only once are forgotten,
    if need be all but the more frequent half.  The library gets words joined by
    spaces: the id that starts a space-led word is one whose piece begins with
    the space, and no other id of the word is."""

    def __init__(self, path: str, dtype, limit: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.lib = load_tokenizer(path)
        self.dtype, self.limit = np.dtype(dtype), limit
        vocab = self.lib.get_vocab(with_added_tokens=True)
        self.leads = np.zeros(max(vocab.values()) + 1, bool)
        self.leads[[i for piece, i in vocab.items() if piece.startswith("\u0120")]] = True  # byte 0x20 in byte-level vocabularies
        self.number = _Numbering()
        self.ids, self.size = np.zeros(1 << 16, self.dtype), 0  # ids of all known words
        self.first, self.count, self.used = (np.zeros(0, np.int64) for _ in range(3))

    def _ids(self, texts: list) -> list:
        return [np.array(e.ids, self.dtype) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list) -> None:
        """Ids of the words numbered last."""
        first, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        plain = [i for i, w in enumerate(words) if w and not w[-1].isspace()]
        rest = [i for i, w in enumerate(words) if not w or w[-1].isspace()]
        for lo in range(0, len(plain), 2000):
            own = plain[lo:lo + 2000]
            flat = self._ids([" " + " ".join([words[i] for i in own])])[0]
            at = np.flatnonzero(self.leads[flat])
            if len(at) != len(own) or at[0] != 0:
                raise ValueError("the tokenizer joins words across a space")
            first[own], count[own] = self._append(flat) + at, np.diff(at, append=len(flat))
        for i, x in zip(rest, self._ids([" " + words[i] for i in rest]), strict=True):
            first[i], count[i] = self._append(x), len(x)
        self._number(first, count, np.zeros(len(words), np.int64))

    def _append(self, ids: np.ndarray) -> int:
        at = self.size
        if at + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:at], np.zeros(max(len(ids), len(self.ids)), self.dtype)])
        self.ids[at:at + len(ids)] = ids
        self.size = at + len(ids)
        return at

    def _number(self, first: np.ndarray, count: np.ndarray, used: np.ndarray) -> None:
        self.first, self.count, self.used = (np.concatenate(x) for x in ((self.first, first), (self.count, count), (self.used, used)))

    def _forget(self) -> None:
        keep = self.used > 1
        if keep.sum() > self.limit // 2:
            keep = np.zeros(len(self.used), bool)
            keep[np.argpartition(self.used, -(self.limit // 2))[-(self.limit // 2):]] = True
        words = [w for w, k in zip(self.number, keep.tolist(), strict=True) if k]
        first, count, used = self.first[keep], self.count[keep], self.used[keep]
        ids = self.ids[within_ranges(first, count)]
        self.number = _Numbering(zip(words, range(len(words)), strict=True))
        self.ids, self.size = np.zeros(max(1 << 16, 2 * len(ids)), self.dtype), 0
        self.first, self.count, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self._append(ids)
        self._number(np.cumsum(count) - count, count, used // 2)

    def encode(self, texts: pa.Array) -> list:
        """The ids of every text, packed."""
        if len(self.number) > self.limit:
            self._forget()
        texts = texts.fill_null("")
        doubled = pc.match_substring_regex(texts, DOUBLE_SPACE)
        out = [b""] * len(texts)
        own = np.flatnonzero(~doubled.to_numpy(zero_copy_only=False)).tolist()
        split = pc.split_pattern(texts.filter(pc.invert(doubled)), " ")
        at, words = split.offsets.to_numpy(), split.flatten()
        distinct = words.dictionary_encode()
        known, names = len(self.used), distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.number.__getitem__, names), np.int64, len(names))
        if len(self.number) > known:
            self._learn(list(itertools.islice(self.number, known, None)))
        counts = self.count[numbers]
        own_ids = self.ids[within_ranges(self.first[numbers], counts)]
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32) * self.dtype.itemsize
        packed = pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer(offsets), pa.py_buffer(own_ids)])
        led = np.ones(len(words), bool)  # all words but the first of a text
        led[at[:-1]] = False
        flat = distinct.indices.filter(pa.array(led))
        self.used[numbers] += np.bincount(flat.to_numpy(), minlength=len(names))
        joined = packed.take(flat)
        ends, raw = (np.frombuffer(joined.buffers()[1], np.int32, len(flat) + 1), memoryview(joined.buffers()[2] or b""))
        stop = ends[at - np.arange(len(at))]
        heads = self._ids(words.take(pa.array(at[:-1])).to_pylist())
        for i, head, lo, hi in zip(own, heads, stop[:-1].tolist(), stop[1:].tolist(), strict=True):
            out[i] = head.tobytes() + raw[lo:hi]
        rest = np.flatnonzero(doubled.to_numpy(zero_copy_only=False))
        for i, ids in zip(rest.tolist(), self._ids(texts.take(pa.array(rest)).to_pylist()), strict=True):
            out[i] = ids.tobytes()
        return out


@functools.lru_cache(maxsize=2)
def word_encoder(path: str, dtype: str) -> WordEncoder:
    """One encoder a worker process: its words serve all tasks there."""
    return WordEncoder(path, dtype)


def _text_slices(texts: pa.Array, limit: int = 1 << 22):
    """(first row, texts) of about ``limit`` bytes."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + limit)))
        yield i, texts.slice(i, j - i)
        i = j


def encode_documents(docs: DataFrame, path: str, ranges: Ranges, end_id: int = 0):
    """(part, doc_id, h, ids): the ids of a text and the end id, packed, with
    the part of its doc_id; and the type of the ids."""
    wide = load_tokenizer(path).get_vocab_size(with_added_tokens=True) > 1 << 16
    kind = "<u4" if wide else "<u2"

    def run(batches):
        enc = word_encoder(path, kind)
        end = np.array([end_id], kind).tobytes()
        for b in batches:
            part = ranges.part_of(b.column("key").to_numpy(), b.column("h").to_numpy()).astype(np.int32)
            for lo, texts in _text_slices(b.column("text")):
                own = b.slice(lo, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[lo:lo + len(texts)]), own.column("doc_id"), own.column("h"),
                     pa.array([x + end for x in enc.encode(texts)], pa.binary())], names=["part", "doc_id", "h", "ids"])

    return id_hash_text(docs).mapInArrow(run, "part int, doc_id long, h long, ids binary"), kind


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_token_files(docs: DataFrame, path: str, end_id: int = 0, folder: str | None = None, parts: int | None = None):
    """Write the files; returns (folder, manifest DataFrame with columns part,
    name, n_docs, n_ids, kind)."""
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "token-ids")
    ranges = text_ranges(docs, FILE_TEXT_BYTES, parts)
    encoded, kind = encode_documents(docs, path, ranges, end_id)
    ordered = encoded.repartition(ranges.parts, "part").sortWithinPartitions("part", "doc_id", "h", "ids")
    fs_, root = _filesystem(folder)
    fs_.create_dir(root, recursive=True)

    def write(batches):
        fs, base = _filesystem(folder)
        part, name, outs, at, n = None, "", None, 0, 0

        def close():
            if outs:
                for o in outs:
                    o.close()
                return pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([name]), pa.array([n], pa.int64()), pa.array([at], pa.int64()),
                     pa.array([kind])], names=["part", "name", "n_docs", "n_ids", "kind"])
            return None

        width = np.dtype(kind).itemsize
        for b in batches:
            p = b.column("part").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(p)) + 1).tolist(), len(p)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if hi == lo:
                    continue
                if p[lo] != part:
                    done = close()
                    if done is not None:
                        yield done
                    part, at, n = int(p[lo]), 0, 0
                    name = f"part-{part:05d}-{uuid.uuid4().hex}"
                    outs = [fs.open_output_stream(f"{base}/{name}.{x}") for x in ("bin", "idx", "doc")]
                    outs[1].write(np.zeros(1, "<u8").tobytes())
                rows = b.slice(lo, hi - lo)
                ids = rows.column("ids").to_pylist()
                ends = at + np.cumsum([len(x) // width for x in ids], dtype=np.int64)
                outs[0].write(b"".join(ids))
                outs[1].write(ends.astype("<u8").tobytes())
                own = rows.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
                outs[2].write(own.astype("<i8").tobytes())
                at, n = int(ends[-1]), n + len(ids)
        done = close()
        if done is not None:
            yield done

    fields = "part int, name string, n_docs long, n_ids long, kind string"
    ordered.mapInArrow(write, fields).write.parquet(f"{folder}/manifest")
    return folder, spark.read.schema(fields).parquet(f"{folder}/manifest")


def partition_bases(manifest: DataFrame) -> list:
    """(part, name, n_docs, n_ids, kind, base): one row per file, so the prefix
    sum over partitions is bounded by their number."""
    base, out = 0, []
    for r in sorted(manifest.collect(), key=lambda r: r["part"]):
        out.append((r["part"], r["name"], r["n_docs"], r["n_ids"], r["kind"], base))
        base += r["n_ids"]
    return out


class IdFile:
    """A .bin/.idx/.doc file as an array of ids: memory-mapped where the folder
    is mounted, else read through the file system's client, only what is asked for."""

    def __init__(self, fs, path: str, kind: str):
        self.kind = np.dtype(kind)
        if fs.type_name == "local":
            self.data = np.memmap(path, dtype=kind, mode="r") if os.path.getsize(path) else np.zeros(0, kind)
            self.size = len(self.data)
        else:
            self.data, self.file = None, fs.open_input_file(path)
            self.size = self.file.size() // self.kind.itemsize

    def __len__(self) -> int:
        return self.size

    def read(self, lo: int, hi: int) -> np.ndarray:
        if self.data is not None:
            return self.data[lo:hi]
        return np.frombuffer(self.file.read_at((hi - lo) * self.kind.itemsize, lo * self.kind.itemsize), self.kind)


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document read back from the files: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32."""
    files = partition_bases(manifest)
    schema = "part int, name string, n_docs long, n_ids long, kind string, base long"
    todo = spark.createDataFrame(files, schema).repartition(max(1, len(files)), "part")

    def read(batches):
        fs, root = _filesystem(folder)
        for b in batches:
            for r in b.to_pylist():
                at = f"{root}/{r['name']}"
                ids, offs, own = (IdFile(fs, f"{at}.{x}", k) for x, k in (("bin", r["kind"]), ("idx", "<u8"), ("doc", "<i8")))
                if len(ids) != r["n_ids"] or len(own) != r["n_docs"] or len(offs) != len(own) + 1:
                    raise ValueError(f"token file {r['name']} is not what the manifest says")
                for lo in range(0, len(own), 4096):
                    hi = min(lo + 4096, len(own))
                    doc, cuts = np.array(own.read(lo, hi)), offs.read(lo, hi + 1).astype(np.int64)
                    crc = [zlib.crc32(ids.read(a, b).astype("<u4").tobytes()) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc, pa.int64(), mask=doc == np.iinfo(np.int64).min), pa.array(cuts[:-1] + r["base"]),
                         pa.array(np.diff(cuts)), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return todo.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = write_token_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return read_token_files(spark, folder, manifest)
