"""Language ID against a plain version of the method; every stage of the corpus
pipeline with nulls, empty texts, repeated rows, clashing names and no rows;
texts above one pass and small blocks."""

import math
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from domus.llm import blocks, bpe, common, decontaminate, language, substrings, suffixes

LETTER = re.compile(r"[^\W\d_]")


# ------------------------------------------------------------ language ID
def plain_grams(text: str) -> dict:
    """Feature -> count of the hashed byte 2- and 3-grams, one at a time."""
    b = [c | 0x20 if 0x41 <= c <= 0x5A else c if c >= 0x61 and (c < 0x7B or c >= 0x80) else 0x20 for c in text.encode()]
    out: dict = {}
    m = 1 << 32
    for i in range(len(b)):
        x, y, z = b[i], b[i + 1] if i + 1 < len(b) else 0x20, b[i + 2] if i + 2 < len(b) else 0x20
        for f in (((x * 257 + y) * 0x9E3779B1 % m) >> 19, (((x * 257 + y) * 263 + z) * 0x85EBCA6B % m) >> 19):
            out[f] = out.get(f, 0) + 1
    return out


def plain_vector(text: str, idf: dict, n: int) -> dict:
    v = {f: math.sqrt(c) * (math.log((1 + n) / (1 + idf.get(f, 0))) + 1) for f, c in plain_grams(text).items()}
    norm = math.sqrt(sum(x * x for x in v.values())) or 1
    return {f: x / norm for f, x in v.items()}


def dot(a: dict, b: dict) -> float:
    return sum(x * b.get(f, 0) for f, x in a.items())


def plain_model(rows):
    """rows: (doc_id, text, lang); fewer learning rows per language than the sample holds."""
    learn = [(t, lang) for i, t, lang in rows if lang is not None and t and LETTER.search(t) and not (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)]
    df: dict = {}
    for t, _ in learn:
        for f in plain_grams(t):
            df[f] = df.get(f, 0) + 1
    centres, far = [], []
    for lang in sorted({k for _, k in learn}):
        x = [plain_vector(t, df, len(learn)) for t, k in learn if k == lang]
        sizes = [len(t.encode()) for t, k in learn if k == lang]
        mean = {f: sum(v.get(f, 0) for v in x) / len(x) for f in set().union(*x)}
        own = [max(x, key=lambda v: dot(v, mean))]
        while len(own) < min(language.CLUSTERS, len(x)):
            own.append(min(x, key=lambda v: max(dot(v, c) for c in own)))
        for _ in range(language.ROUNDS):
            at = [max(range(len(own)), key=lambda j: dot(v, own[j])) for v in x]
            new = []
            for j in range(len(own)):
                members = [v for v, k in zip(x, at, strict=True) if k == j]
                s = {f: sum(v.get(f, 0) for v in members) for f in set().union(*members)} if members else own[j]
                norm = math.sqrt(sum(v * v for v in s.values()))
                new.append({f: v / norm for f, v in s.items()})
            own = new
        centres += [(lang, c) for c in own]
        far += [(min(7, max(0, int(math.log2(max(n, 1))) - 3)), 1 - max(dot(v, c) for c in own)) for v, n in zip(x, sizes, strict=True)]
    return df, len(learn), centres, far


def test_language_equals_a_plain_version(docs_of, spark, monkeypatch):
    import random

    rng = random.Random(2)
    vocab = {"aa": ["the", "and", "of", "house", "water"], "bb": ["der", "und", "Häuser", "für", "über"], "cc": ["le", "été", "où", "maison", "forêt"]}
    rows = [(i, " ".join(rng.choice(vocab[k]) for _ in range(rng.choice([4, 20, 60]))), k) for i, k in ((i, rng.choice("abc") * 2) for i in range(90))]
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "12 34", "cc"), (203, "the water", None), (204, "xyz qq", None), (3, rows[3][1], rows[3][2]), (None, "der und", "bb")]
    df = spark.createDataFrame([(i, t, k, 1, "x") for i, t, k in rows], "doc_id long, text string, lang string, rejected int, score string")
    monkeypatch.setattr(language, "table", lambda *a: df)
    got = sorted(((r["doc_id"], r["held_out"], r["lang_pred"], r["score"], r["rejected"]) for r in language.op3_language(spark, "").collect()), key=str)
    idf, n, centres, far = plain_model(rows)
    bands = [max([d for b, d in far if b >= j], default=None) for j in range(8)]
    want = []
    for i, t, _ in rows:
        held = i is not None and zlib.crc32(str(i).encode()) % 4 == 2
        if not t or not LETTER.search(t):
            want.append((i, held, "und", 0.0, True))
            continue
        v = plain_vector(t, idf, n)
        lang, centre = max(centres, key=lambda c: dot(v, c[1]))  # the first of equals
        score = dot(v, centre)
        limit = bands[min(7, max(0, int(math.log2(len(t.encode()))) - 3))]
        want.append((i, held, lang, score, None if limit is None else 1 - score > min(1.0, limit * language.SLACK)))
    want.sort(key=str)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-5)
    clear = [(g, w) for g, w in zip(got, want, strict=True) if w[4] is not None]
    assert clear and all(g[4] == w[4] for g, w in clear)


# ------------------------------------------------------------ pipeline stages
@pytest.fixture
def odd(docs_of, plain_rows):
    rows = plain_rows + [(None, "token: abcdef12345"), (None, None), (50, "password = hunter2222 and the rest"), (51, "the the the")]
    return docs_of(rows)


@pytest.fixture
def bench(spark):
    return spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11", 0), (None, "the the the", 1), (3, None, 2)], "item_id long, text string, words int")


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_keep_columns_and_stand_odd_rows(spark, odd, bench, monkeypatch, name, stage):
    monkeypatch.setattr(common, "table", lambda s, d, t: bench)
    out = stage(spark, odd, "")
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == odd.columns
        kept, before = ([tuple(r) for r in x.drop("text").collect()] for x in (out, odd))
        assert all(before.count(r) >= kept.count(r) for r in kept)
    else:
        assert out.count() == odd.count()
    empty = stage(spark, odd.limit(0), "")
    assert empty.columns == out.columns and empty.count() == 0


def test_the_whole_pipeline_on_odd_rows(spark, odd, bench, monkeypatch):
    tables = {"documents": odd, "benchmark": bench}
    monkeypatch.setattr(common, "table", lambda s, d, t: tables[t])
    assert 0 < corpus_pipeline.run(spark, "").count() < odd.count()
    tables["documents"] = odd.limit(0)
    assert corpus_pipeline.run(spark, "").count() == 0


def test_an_item_without_an_id_hits_but_has_no_name(spark, docs_of, bench, monkeypatch):
    got = decontaminate.decontaminate(docs_of([(1, "and the the the end"), (2, "the the"), (3, None)]), bench)
    assert {(r["doc_id"], r["n_hit"], r["n_items"], r["contaminated"]) for r in got.collect()} == {(1, 3, 0, True), (2, 0, 0, False), (3, 0, 0, False)}
    windows = {(r["length"], bytes(r["words"])): list(r["items"]) for r in decontaminate.item_windows(bench).collect()}
    assert windows[3, b"the the the"] == [] and windows[10, b"w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"] == ["1"] and len(windows) == 3


def test_blocks_of_windows_are_passed_one_by_one(spark, docs_of, plain_rows, monkeypatch):
    items = spark.createDataFrame([(i, t) for i, t in plain_rows[:6]], "item_id long, text string")
    docs = docs_of(plain_rows)
    key = lambda df: sorted(map(str, df.collect()))
    one, clean = key(decontaminate.decontaminate(docs, items)), key(decontaminate.keep_clean(docs, items))
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK_CHARS", 4000)
    assert decontaminate.window_blocks(items)[0] > 2
    assert key(decontaminate.decontaminate(docs, items)) == one and key(decontaminate.keep_clean(docs, items)) == clean


# ------------------------------------------------------------ sizes
def test_small_blocks_change_nothing(docs_of, plain_rows, monkeypatch):
    docs = docs_of(plain_rows).repartition(2)
    key = lambda df: sorted(map(str, df.collect()))
    one = key(substrings.drop_repeats(docs)), key(suffixes.drop_repeated_bytes(docs))
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 300)
    assert blocks.text_blocks(docs).count() > 6
    assert (key(substrings.drop_repeats(docs)), key(suffixes.drop_repeated_bytes(docs))) == one


def test_texts_above_one_pass(docs_of):
    import random

    rng = random.Random(6)
    shared = " ".join("s%d" % rng.randrange(10 ** 6) for _ in range(120))
    long = " ".join("v%d" % rng.randrange(10 ** 6) for _ in range(200_000))
    assert len(long) > common.SLICE_BYTES
    rows = [(1, shared), (2, long[:700_000] + " " + shared + " " + long[700_000:]), (3, "short")]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substrings.drop_repeats(docs_of(rows)).collect()}
    assert got[1] == (120, 0) and got[2][1] == 120 and got[3] == (1, 0)
    cut = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in suffixes.drop_repeated_bytes(docs_of(rows)).collect()}
    assert cut[1] == (len(shared), len(shared)) and cut[2] == (len(rows[1][1]), len(shared)) or cut[2][1] >= len(shared)
    ids = {r["doc_id"]: r["n_tokens"] for r in bpe.encode_decode(docs_of(rows), bpe.tokenizer_path("word_bpe_49k.json")).collect()}
    lib = bpe.load_tokenizer(bpe.tokenizer_path("word_bpe_49k.json"))
    assert ids[2] == len(lib.encode(rows[1][1], add_special_tokens=False).ids)
