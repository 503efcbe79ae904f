"""SuperMinHash near duplicates against brute force: odd rows, made near copies, both ways of pairing."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cdc_lake.llm import common as C
from cdc_lake.llm import superminhash as S
from cdc_lake.llm import wordhash as H

from .conftest import ODD, SF_SMALL

FOLD = {i: i + 32 for i in range(65, 91)}


def plain(rows, percent=80):
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text) rows."""
    sets = []
    for _, t in rows:
        w = [x for x in re.split("[\x20\x09-\x0D]+", (t or "").translate(FOLD)) if x]
        sets.append({tuple(w[k:k + 2]) for k in range(max(1, len(w) - 1))} if w else set())
    at = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            at[x].append(k)
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in at[x] if j < k).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                up[find(k)] = find(j)
    low = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        low[r] = i if low.get(r) is None else low[r] if i is None else min(i, low[r])
    out = [(i, len(s), low[find(k)] if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))]
    return sorted(((i, n, c, i == c) for i, n, c in out), key=repr)


def result(df, **kw):
    return sorted((tuple(r) for r in S.near_duplicates(df, **kw).collect()), key=repr)


def test_odd_rows_equal_plain(spark, odd, empty):
    assert result(odd) == plain(ODD)
    assert S.near_duplicates(empty).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(empty) == []


@pytest.mark.parametrize("block", [S.BLOCK, 3])
def test_made_near_copies_equal_plain(spark, block):
    """Families that share boilerplate: members of a band that are unlike its smallest member are found as well."""
    rng = random.Random(11)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(400))
    boiler = [word() for _ in range(60)]
    rows, n = [], 0
    for _ in range(30):
        own = boiler[:rng.randrange(20, 60)] + [word() for _ in range(rng.randrange(10, 60))]
        for _ in range(rng.randrange(1, 6)):
            w = list(own)
            for _ in range(rng.randrange(0, 6)):
                w[rng.randrange(len(w))] = word()
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n + k, rows[0][1]) for k in range(40)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(df, block=block) == plain(rows)


def test_given_documents_equal_plain(spark):
    docs = C.table(spark, SF_SMALL, "documents")
    assert result(docs) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_long_texts_are_read_in_slices():
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(3_000)}" for _ in range(40_000)) + "\n" + "z" * 5_000
    whole, _ = S.sets([text], 2, 1 << 30)
    for chars in (1_000, 7_777, 100_000):
        got, offsets = S.sets(["a b", text, None], 2, chars)
        assert (got[offsets[1]:offsets[2]] == whole).all() and offsets[3] == offsets[2]
    assert (S.long_set("x" * 9_000, 2, 1_000) == S.sets(["x" * 9_000], 2, 1 << 30)[0]).all()


def test_signature_by_blocks_and_variance():
    """Shingles taken in any blocks give the same signature; the estimate's error is below plain MinHash's."""
    rng = np.random.default_rng(4)
    errors = []
    for _ in range(80):
        x = rng.integers(0, 1 << 62, 110).astype(H.U)
        a, b = np.sort(x[:100]), np.sort(x[10:])
        sig = S.signatures(np.concatenate((a, b)), np.array([0, 100, 200]))
        errors.append((sig[0] == sig[1]).mean() - 90 / 110)
    j = 90 / 110
    assert abs(np.mean(errors)) < 0.015
    assert np.std(errors) < (j * (1 - j) / S.SIZE) ** 0.5
    before = S.SHINGLES
    try:
        S.SHINGLES = 37
        assert (S.signatures(np.concatenate((a, b)), np.array([0, 100, 200])) == sig).all()
    finally:
        S.SHINGLES = before
