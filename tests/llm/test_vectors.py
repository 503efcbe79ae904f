"""Hard negatives and subvector clustering against plain Python on odd rows, and every way through them."""

import hashlib
import math
import random

import numpy as np
import pytest

from cdc_lake.llm import hard_negatives as HN
from cdc_lake.llm import subvector_clusters as SC

VECTORS = "vec_id long, label int, embedding array<float>, rid int, v string, cluster int, score long"


def make(spark, rows):
    """Rows (vec_id, label, embedding) with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], VECTORS)


def vector(rng, dim=64, spread=0.3):
    return [float(np.float32(rng.gauss(0, spread))) for _ in range(dim)]


@pytest.fixture(scope="module")
def odd_vectors():
    rng = random.Random(3)
    base = [vector(rng) for _ in range(6)]
    rows = []
    for i in range(420):
        near = [float(np.float32(x + rng.gauss(0, 0.05))) for x in base[i % 6]]
        rows.append((i, i % 5, near))
    rows += [(500 + i, 1, rows[0][2]) for i in range(60)]           # copies that tie
    rows += [(500 + i, 2, rows[0][2]) for i in range(60)]           # the same ids again, another label
    rows += [(700, 3, [0.0] * 64), (800, None, base[0]), (801, 1, None), (802, 1, [None] + base[0][1:]),
             (803, 1, [float("nan")] + base[0][1:]), (804, 2, [float("inf")] + base[0][1:]), (None, 1, base[1]),
             (900, 1, base[2]), (900, 1, base[2])]
    return rows


def usable(rows):
    return [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]


def plain_negatives(rows, scale=256):
    rows = [(k, i, (y + 1) % 10 if i is not None and i % 7 == 0 else y, [math.floor(scale * x) for x in e])
            for k, (i, y, e) in enumerate(usable(rows)) if y is not None]
    out = []
    for k, i, y, a in rows:
        if i is None or i % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(a, e)), j is None, j or 0, r, j, z) for r, j, z, e in rows if r != k)
        for ps, _, _, _, pos, _ in [s for s in scored if s[5] == y][:5]:
            fit = [s for s in scored if s[5] != y and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:10]
            out += [(i, pos, n + 1, s[4], -ps, -s[0]) for n, s in enumerate(fit)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("kw", [{}, {"per_pass": 3, "clusters": 2}, {"many_tasks": 0}])
def test_negatives_equal_plain(spark, odd_vectors, kw):
    got = sorted((tuple(r) for r in HN.hard_negatives(make(spark, odd_vectors), **kw).collect()), key=repr)
    assert got == plain_negatives(odd_vectors) and got


def test_negatives_of_small_and_empty_tables(spark, odd_vectors):
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    for rows in ([], [(1, 1, [0.5] * 64)], [(100, 1, [0.5] * 64)], [(100, 1, []), (101, 1, []), (102, 2, [])]):
        df = HN.hard_negatives(make(spark, rows))
        assert df.columns == cols
        assert sorted(tuple(r) for r in df.collect()) == plain_negatives(rows)


def test_negatives_of_large_and_uneven_components(spark):
    rng = random.Random(5)
    rows = [(i, i % 3, [rng.gauss(0, 1e9) for _ in range(rng.choice((3, 5)))]) for i in range(0, 230)]
    rows = [(i, y, [float(np.float32(x)) for x in e]) for i, y, e in rows]
    got = sorted((tuple(r) for r in HN.hard_negatives(make(spark, rows), scale=1).collect()), key=repr)
    assert got == plain_negatives(rows, 1) and got


def test_walk_ends_before_the_list_does():
    """Tight clusters: the certified end leaves most of the candidates unwalked."""
    rng = np.random.default_rng(7)
    centres = np.linalg.qr(rng.normal(size=(64, 64)))[0] * 256
    m = np.floor(centres[np.arange(16_000) % 8] + rng.normal(size=(16_000, 64)) * 2)
    label = np.arange(16_000) % 2
    a = m[:8 * 20:8]
    g = HN.Group(centres[0] / 256, a, np.arange(0, 160, 8), label[:160:8], np.full((20, 1), HN.LOW), np.full((20, 1), HN.NONE),
                 np.full((20, 1), HN.LOW))
    places, walked = HN.Places(g, 5), []
    HN.walk(g, places, m, np.arange(len(m)), np.arange(len(m)), label, np.linalg.norm(m, axis=1), HN._unit(m), True, walked)
    assert len(places.at[0]) == 100
    assert sum(walked) < 20 * len(m) / 2 / 2  # half of the candidates have the label; under half of those are walked
    score = (a @ m[label == 0].T).astype(int)
    for i in range(20):
        best = sorted((-s, v) for v, s in zip(np.flatnonzero(label == 0).tolist(), score[i].tolist()) if v != i * 8)[:5]
        mine = places.at[0] == i
        assert [(-s, v) for s, v in zip(places.at[1][mine].tolist(), places.at[2][mine].tolist())] == best


def plain_clusters(rows, scale=64, k=16, rounds=3):
    v = [(i, [math.floor(scale * x) for x in e]) for i, _, e in usable(rows) if len(e) == 64]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    cents = [x for _, x in sorted((sha(f"1:{'' if i is None else i}"), x) for i, x in v)[:k]]
    for r in range(rounds + 1):
        near = [min((sum((p - q) ** 2 for p, q in zip(x, c)), j) for j, c in enumerate(cents)) for _, x in v]
        if r < rounds:
            for j in range(len(cents)):
                own = [x for (_, n), (_, x) in zip(near, v) if n == j]
                cents[j] = [sum(c) // len(own) for c in zip(*own)] if own else cents[j]
    per = {j: sum(d for d, n in near if n == j) for j in range(len(cents))}
    whole = sum(per.values())
    return sorted(((i, j, d, per[j], whole, sha(",".join(map(str, cents[j])))) for (i, _), (d, j) in zip(v, near)), key=repr)


@pytest.mark.parametrize("entries", [SC.ENTRIES, 300, 5])
def test_clusters_equal_plain(spark, odd_vectors, entries):
    """Widths 4, a narrower one, and the dictionary as a table."""
    df = make(spark, [*odd_vectors, (950, 1, [0.5] * 63), (951, 1, []), (952, 1, [0.5] * 65)])
    got = sorted((tuple(r) for r in SC.subvector_clusters(df, entries=entries).collect()), key=repr)
    assert got == plain_clusters(odd_vectors)


def test_clusters_of_few_and_no_vectors(spark):
    cols = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    for rows in ([], [(1, 1, None)], [(1, 1, [0.25] * 64), (2, 1, [0.25] * 64), (3, None, [-0.25] * 64)]):
        df = SC.subvector_clusters(make(spark, rows))
        assert df.columns == cols
        assert sorted((tuple(r) for r in df.collect()), key=repr) == plain_clusters(rows)


def test_clusters_of_large_components(spark):
    """Beyond 64-bit squares the arithmetic is exact all the same; distances saturate at the largest long."""
    rng = random.Random(9)
    rows = [(i, 1, [float(np.float32(rng.gauss(0, 2e6))) for _ in range(64)]) for i in range(60)]
    want = plain_clusters(rows)
    assert max(r[2] for r in want) < 1 << 63
    for entries in (SC.ENTRIES, 5):
        got = sorted((tuple(r) for r in SC.subvector_clusters(make(spark, rows), entries=entries).collect()), key=repr)
        assert [r[:3] + r[5:] for r in got] == [r[:3] + r[5:] for r in want]


def test_coding_is_lossless():
    rng = np.random.default_rng(1)
    m = np.floor(rng.normal(size=(500, 64)) * 3)
    for w in SC.WIDTHS:
        words = SC.Dictionary(w, [np.unique(m[:, b:b + w], axis=0) for b in range(0, 64, w)])
        codes = words.encode(m)
        back = np.concatenate([s[codes[:, b]] for b, s in enumerate(words.subs)], axis=1)
        assert (back == m).all()
