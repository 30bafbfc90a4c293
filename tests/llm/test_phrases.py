"""Phrase collocations against a brute-force count."""

import collections
import random
import re

import numpy as np
import pytest

from domus.llm import phrases as P

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, threshold, top):
    """rows: (lang, text)."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    out = collections.defaultdict(list)
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= threshold}
    absorbed = set()
    for (lang, w), a in cand.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                if 100 * a >= 80 * f[lang, w[i:i + size]]:
                    absorbed.add((lang, w[i:i + size]))
    for (lang, w), a in cand.items():
        if (lang, w) in absorbed:
            continue
        score, _, left, right = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, r + 1, p.decode(), -a, x, y, n[lang], -s) for lang, v in out.items() for r, (s, a, p, x, y) in enumerate(sorted(v)[:top]))


@pytest.fixture
def rows():
    rng = random.Random(3)
    words = ["a", "b", "été", "ÜB", "d-e", "x\x00y", "naïve", "the"]
    text = lambda n, m=8: "".join(rng.choice(words[:m]) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " !? "]) for _ in range(n))
    hot = "machine learning models. New York City\thall "
    out = [("en", text(300)), ("en", text(500, 4)), ("fr", text(200)), (None, text(150)), ("und", text(150)), ("", text(100)), ("en", None), ("en", ""),
           ("fr", " \t\n.,"), ("en", hot.upper()), ("de", "one")] + [("en", hot)] * 40 + [("en", "und" + " so" * 400)]
    return out


def table_of(spark, rows):
    return spark.createDataFrame([(i, t, k, 1, "b", 2) for i, (k, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n long, phrase string, words int")


@pytest.mark.parametrize("threshold,top", [(3, 1000), (3, 4), (30, 2000)])
def test_collocations(spark, rows, threshold, top):
    got = sorted(map(tuple, P.collocations(table_of(spark, rows).repartition(5), threshold, top).collect()))
    want = brute(rows, threshold, top)
    assert got == want and want


def test_small_blocks_and_texts_cut_between_pieces(spark, rows, monkeypatch):
    docs = table_of(spark, rows)
    small = P.phrase_blocks(docs.repartition(2), limit=600)
    assert small.count() > 10 and small.select("block").distinct().count() == small.count()
    monkeypatch.setattr(P, "phrase_blocks", lambda d: small)
    got = {tuple(r) for r in P.frequent_phrases(docs, 5).collect()}
    monkeypatch.undo()
    assert got == {tuple(r) for r in P.frequent_phrases(docs, 5).collect()}
    x = P.normal_form(rows[0][1].encode())
    assert b"".join(p.tobytes() for p in P.cut_pieces(x, 50)) == x.tobytes()
    assert all(p[-1] == 10 for p in P.cut_pieces(x, 50))


def test_query_on_no_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(P, "table", lambda s, d, name: table_of(spark, rows).limit(0))
    got = P.op11_phrases(spark, "")
    assert got.collect() == [] and got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_no_frequent_class_is_lost(monkeypatch):
    rng = np.random.default_rng(4)
    blobs, total = [], collections.Counter()
    for _ in range(40):
        own = np.concatenate([rng.integers(0, 1 << 20, 500), np.repeat(rng.integers(0, 40, 10), 2)]).astype(np.uint64)
        keys, counts = np.unique(own, return_counts=True)
        total.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        blobs.append(P.pack_counts(keys, counts))
        back = P.unpack_counts(blobs[-1])
        assert np.array_equal(back[0], keys) and np.array_equal(back[1], counts)
    monkeypatch.setattr(P, "MERGE_ROWS", 300)
    alive = set(P.summarise(blobs, 12).tolist())
    frequent = {k for k, v in total.items() if v >= 12}
    assert frequent and frequent <= alive and len(alive) < len(total) / 20


def test_summary_stays_within_its_capacity():
    summary = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    rng = np.random.default_rng(5)
    mass = 0
    for _ in range(30):
        keys = rng.integers(0, 1000, 200).astype(np.uint64)
        summary = P.misra_gries(summary, keys, np.ones(200, np.int64), 50)
        mass += 200
        assert len(summary[0]) <= 50 and summary[2] <= mass / 51


def test_products_above_64_bits(spark):
    big = 10 ** 15
    freq = spark.createDataFrame([("en", "a b", 2, 3 * big), ("en", "a", 1, 4 * big), ("en", "b", 1, 7 * big)], "lang string, phrase string, words int, n long")
    r = P.drop_absorbed(P.score_phrases(freq)).collect()
    assert [(x["score"], x["l"], x["r"]) for x in r] == [(2_000_000 * 3 // 11, 4 * big, 7 * big)]
