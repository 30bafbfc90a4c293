"""I-Match fingerprints: the contract's columns against brute force, the
fingerprints against a plain version of the method, and their behaviour."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from domus.llm import fingerprints as I
from domus.llm import ranges as R
from domus.llm.common import gram_hashes, mix64, word_hashes

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def term(w: bytes) -> int:
    return int(word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])


def terms_of(text: str) -> set:
    return {term(w) for w in WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()))}


def plain_print(text: str, lex: set) -> tuple:
    own = sorted(terms_of(text) & lex)
    if not own:
        return "t:" + hashlib.sha256(text.encode()).hexdigest()[:32], None
    level = max(0, math.ceil(math.log2(len(own) / 3)))
    cells = []
    for up in (0, 1):
        for s in range(1, I.SUBSETS + 1):
            salt = int(mix64(np.array([s * 0x9E3779B97F4A7C15 % 2 ** 64], np.uint64))[0])
            kept = [t for t in own if int(mix64(np.array([t ^ salt], np.uint64))[0]) < 2 ** (64 - level - up)]
            h = int(gram_hashes(np.array(kept, np.uint64), np.array([0]), np.array([len(kept)]))[0]) if kept else None
            cells.append("-" if h is None else f"{(h >> 33) + 1:08x}")
    return f"{level}:" + "".join(cells), (level, cells)


def like(a, b, x, y):
    if a is None and b is None:
        return float(x == y)
    if a is None or b is None:
        return 0.0
    pairs = [(p, q) for u in (0, 1) for v in (0, 1) if a[0] + u == b[0] + v
             for p, q in zip(a[1][u * I.SUBSETS:][:I.SUBSETS], b[1][v * I.SUBSETS:][:I.SUBSETS], strict=True) if (p, q) != ("-", "-")]
    return sum(p == q for p, q in pairs) / len(pairs) if pairs else 0.0


def brute(rows, least, most):
    df = collections.Counter(t for _, x in rows for t in terms_of(x or ""))
    lex = {t for t, n in df.items() if max(1, math.ceil(least * len(rows))) <= n <= max(1, int(most * len(rows)))}
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    out = []
    for (i, x), (_, y) in zip(rows, [*rows[1:], rows[0]], strict=True):
        x, y = x or "", y or ""
        n = len(x) // 4
        e = x[:len(x) - n] + y[:n]
        (px, a), (pe, b), (_, c) = (plain_print(t, lex) for t in (x, e, y))
        out.append((i, len(x), hashlib.sha256(e.encode()).hexdigest(), px, pe, like(a, b, x, e), like(a, c, x, y)))
    return sorted(out, key=str)


@pytest.fixture
def texts(plain_rows):
    rng = random.Random(9)
    words = ["t%d" % i for i in range(400)]
    rows = [(i, t) for i, t in plain_rows if i != 10] + [(None, "first of all, été"), (-5, "x")]
    return rows + [(100 + 3 * i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 40, 300])))) for i in range(60)]


@pytest.mark.parametrize("least,most", [(0.001, 0.5), (0.05, 0.2)])
def test_fingerprints(spark, docs_of, texts, least, most):
    got = sorted(map(tuple, I.fingerprint_documents(docs_of(texts).repartition(3), least, most).collect()), key=str)
    want = brute(texts, least, most)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want])


def test_small_parts_and_stretches(spark, docs_of, texts, monkeypatch):
    want = sorted(map(tuple, I.fingerprint_documents(docs_of(texts)).collect()), key=str)
    monkeypatch.setattr(I, "text_ranges", lambda d: R.text_ranges(d, part_bytes=500))
    assert R.text_ranges(docs_of(texts), part_bytes=500).parts > 50
    assert sorted(map(tuple, I.fingerprint_documents(docs_of(texts).repartition(2)).collect()), key=str) == want


def test_query_edges(spark, docs_of, monkeypatch):
    def run(rows):
        monkeypatch.setattr(I, "table", lambda s, d, name: docs_of(rows))
        return sorted(map(tuple, I.op13_fingerprints(spark, "").collect()), key=str)

    assert run([]) == []
    assert [r[:2] + r[5:] for r in run([(4, None)])] == [(4, 0, 1.0, 1.0)]
    same = run([(1, "ab cd"), (1, "ab cd"), (1, "zz"), (None, ""), (None, None)])
    assert len(same) == 5 and len({r[3] for r in same if r[0] == 1}) == 2
    # a doc_id that most rows share is spread over parts and stays in order
    many = [(7, f"text number {i} of many") for i in range(300)] + [(i, "other words here") for i in range(100, 110)]
    got = run(many)
    h = {r["text"]: r["h"] for r in R.id_hash_text(docs_of(many)).collect()}
    order = sorted(many, key=lambda r: (r[0], h[r[1]], r[1]))
    edit = sorted(hashlib.sha256(I.edited(x, y).encode()).hexdigest() for (_, x), (_, y) in zip(order, [*order[1:], order[0]], strict=True))
    assert sorted(r[2] for r in got) == edit
    ranges = R.text_ranges(docs_of(many), part_bytes=100)
    key, x = np.array([r[0] for r in order]), np.array([h[r[1]] for r in order])
    part = ranges.part_of(key, x)
    assert (np.diff(part) >= 0).all() and len(set(part.tolist())) > 20


def test_edits_are_near_and_neighbours_are_not(spark, docs_of):
    rng = random.Random(1)
    words = ["w%d" % i for i in range(3000)]
    rows = [(i, " ".join(words[min(int(rng.paretovariate(0.5)), 2999)] for _ in range(rng.choice([60, 300, 2000])))) for i in range(300)]
    got = I.fingerprint_documents(docs_of(rows)).toPandas()
    assert got.near_edited.mean() > 3 * got.near_next.mean() and (got.near_edited > got.near_next).mean() > 0.9


def test_lexicon_is_checked_before_it_is_sent(spark, docs_of, texts):
    terms = I.lexicon(docs_of(texts), len(texts), 4)
    with pytest.raises(ValueError, match="least share"):
        I.lexicon_array(terms, limit=10)
