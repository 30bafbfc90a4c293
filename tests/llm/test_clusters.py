"""Centroid clustering against plain Lloyd rounds in integers."""

import hashlib
import math

import numpy as np
import pytest

from domus.llm import clusters as C


def brute(rows, k, rounds, dims, scale):
    kept = [(i, tuple(math.floor(scale * float(x)) for x in v)) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], []
    raw = {id(r): r for r in kept}
    first = sorted(raw.values(), key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    centroids = [list(v) for _, v in first]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(centroids)):
            members = [v for (_, v), (x, _) in zip(kept, own, strict=True) if x == c]
            if members:
                centroids[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    own = assign()
    total = sum(d for _, d in own)
    inertia = [sum(d for x, d in own if x == c) for c in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], total, sha[c]) for (i, _), (c, d) in zip(kept, own, strict=True)), key=str), own


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, distance long, v string")


@pytest.fixture
def rows():
    rng = np.random.default_rng(8)
    middles = rng.normal(size=(9, 64)) * 3
    out = [(i, (middles[i % 9] + rng.normal(size=64) * (0.2 + i % 3)).tolist()) for i in range(700)]
    bad = [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [1.0] * 63 + [None]), (2004, [float("nan")] * 64), (2005, [float("inf")] * 64)]
    return out + bad + [out[3], out[3], (5, out[9][1]), (None, out[4][1]), (3000, [0.0] * 64), (3001, [0.0] * 64), (-7, [-1e-9] * 64)]


def test_clusters(spark, rows, monkeypatch):
    monkeypatch.setattr(C, "table", lambda s, d, name: frame(spark, rows).repartition(3))
    got = sorted(map(tuple, C.op12_clusters(spark, "").collect()), key=str)
    assert got == brute(rows, 40, 5, 64, 256)[0]


def test_large_components_and_few_vectors(spark, rows):
    big = [(i, [x * 1e4 for x in v]) for i, v in rows[:60]]
    assert sorted(map(tuple, C.cluster(frame(spark, big), k=7).collect()), key=str) == brute(big, 7, 5, 64, 256)[0]
    few = rows[:3] + rows[700:706]
    assert sorted(map(tuple, C.cluster(frame(spark, few)).collect()), key=str) == brute(few, 40, 5, 64, 256)[0]
    one = C.cluster(frame(spark, rows[:50]), k=1, rounds=2)
    assert sorted(map(tuple, one.collect()), key=str) == brute(rows[:50], 1, 2, 64, 256)[0]
    with pytest.raises(Exception, match="larger than"):
        C.cluster(frame(spark, [(1, [1e300] * 64)])).collect()


def test_no_vectors(spark, rows):
    for df in (frame(spark, rows).limit(0), frame(spark, rows[700:706])):
        got = C.cluster(df)
        assert got.collect() == [] and got.columns[:3] == ["vec_id", "cluster", "distance"]


def test_bounds_spare_comparisons(spark, rows):
    log = []
    C.cluster(frame(spark, rows), k=9, rounds=5, log=log)
    assert log[0] == 707 and min(log[1:]) < 350


def test_approach_is_a_bound_and_below_the_drift():
    rng = np.random.default_rng(2)
    tighter = 0
    for _ in range(300):
        dims = int(rng.integers(2, 6))
        centre, old = rng.normal(size=(2, dims)) * 3
        new = old + rng.normal(size=dims) * rng.choice([0.01, 0.5, 3])
        radius = float(rng.choice([0.1, 1, 4]))
        x = rng.normal(size=(400, dims))
        x = centre + x / np.linalg.norm(x, axis=1)[:, None] * radius * np.sqrt(rng.random((400, 1)))
        most = (np.linalg.norm(x - old, axis=1) - np.linalg.norm(x - new, axis=1)).max()
        bound = C.approach(centre, radius, old[None], new[None])[0]
        drift = np.linalg.norm(new - old)
        assert most <= bound <= drift * (1 + 1e-6)
        tighter += bound < 0.9 * drift
    assert tighter > 100
    assert C.approach(np.zeros(2), 1.0, np.ones((1, 2)), np.ones((1, 2)))[0] == 0
