"""N-gram join and paragraph dedup against brute force; components; word hashes."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cdc_lake.llm import common as C
from cdc_lake.llm import para_dedup
from cdc_lake.llm import wordhash as H
from cdc_lake.llm.components import components
from cdc_lake.llm.ngram_join import band_starts, drop_near_copies, ngram_components, plan
from cdc_lake.llm.para_dedup import marks, repeated_passages, tune

from .conftest import ODD, SF_SMALL


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """{row number: smallest id reachable}"""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low = defaultdict(list)
    for a in range(len(rows)):
        low[find(a)].append(rows[a][0])
    name = {k: min((i for i in v if i is not None), default=None) for k, v in low.items()}
    return [(str(rows[a][0]), len(sets[a]), str(name[find(a)])) for a in range(len(rows))]


def check(rows, df):
    got = [(str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_components(df).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_documents_equal_brute_force(spark):
    docs = C.table(spark, SF_SMALL, "documents")
    check([(r.doc_id, r.text) for r in docs.collect()], docs)


def edited(words, rnd, edits):
    words = list(words)
    for _ in range(edits):
        k = rnd.randrange(len(words))
        words[k] = f"e{rnd.randrange(10 ** 9)}"
    return words


def test_chains_hubs_boilerplate_and_borderline_pairs(spark):
    rnd = random.Random(11)
    rows, i = [], 0
    plate = [f"p{k}" for k in range(60)]
    for size in (1, 3, 5, 6, 8, 9, 12, 20, 40, 90, 200, 400, 900):
        base = [f"b{size}_{k}" for k in range(size)]
        for step in range(7):  # a chain: every text is an edit of the one before
            rows.append((i, " ".join(base)))
            base = edited(base, rnd, max(1, size // 40))
            i += 1
    for _ in range(40):  # unlike texts that share a long passage
        own = [f"o{rnd.randrange(10 ** 9)}" for _ in range(rnd.choice((40, 150, 260)))]
        rows.append((i, " ".join(own[:20] + plate + own[20:])))
        i += 1
    hub = [f"h{k}" for k in range(150)]
    for _ in range(40):  # near copies of one text, many of them not linked with each other
        rows.append((i, " ".join(edited(hub, rnd, 3))))
        i += 1
    rnd.shuffle(rows)
    check(rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3))


def test_odd_rows(odd, empty):
    check(ODD, odd)
    assert ngram_components(empty).count() == 0
    kept = drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {None, 1, 2, 3, 4, 5, 6, 7, 8}


def test_bands_hold_every_linked_pair():
    starts = band_starts()
    for small in list(range(1, 400)) + [10 ** 4, 10 ** 6]:
        large = 4 * small // 3
        a, b = (int(np.searchsorted(starts, x, side="right")) - 1 for x in (small, large))
        assert b - a <= 1
        for tier in range(12):
            share, apart, cells = plan(a, tier)
            assert cells > apart
            if share == 1:
                assert apart >= (small + large) // 7


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        if len(seen) > 1:
            assert got[start] == min(seen)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_do_not_depend_on_the_batch():
    texts = ["A b  c", None, "", "c b a", "é\x85 B\tc d e f g", "b c d e f"]
    h, o = H.words(texts)
    assert np.diff(o).tolist() == [3, 0, 0, 3, 7, 5]
    for i, t in enumerate(texts):
        assert np.array_equal(H.words([t])[0], h[o[i]:o[i + 1]])
    values, own = H.shingles(h, o)
    assert own.tolist() == [0, 3, 4, 4, 4, 5]
    assert values[5] in values[2:5] and values[0] != values[1]


def test_paragraph_marks_follow_the_content():
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 2 ** 63, 46).astype(np.uint64)
    found = []
    for _ in range(2):
        x = np.concatenate((rng.integers(0, 2 ** 63, rng.integers(30, 90)).astype(np.uint64), passage,
                            rng.integers(0, 2 ** 63, 60).astype(np.uint64)))
        at = len(x) - 60 - 46
        got = np.flatnonzero(marks(x, np.zeros(len(x), int), 22))
        assert np.diff(got).max() <= 22
        found.append({int(k - at) for k in got if at <= k < at + 46})
    assert len(found[0] & found[1]) >= 2


def test_bands_are_tuned():
    assert tune(0.75, 0.98, 4) == (3, 1)
    assert tune() == (5, 2)
    with pytest.raises(ValueError):
        tune(0.5, 0.99999, 2)


def test_passages_inside_lines_are_found(spark):
    rnd = random.Random(8)
    word = lambda: f"w{rnd.randrange(10 ** 9)}"
    rows = []
    for g in range(30):
        passage = [word() for _ in range(rnd.randint(60, 200))]
        for _ in range(rnd.randint(2, 4)):
            own = [word() for _ in range(rnd.randint(50, 400))]
            k = rnd.randrange(len(own))
            copy = list(passage)
            if len(passage) >= 120:  # a near copy with two equal parts of 50 words or more
                copy[len(copy) // 2] = word()
            rows.append((len(rows), " ".join(own[:k] + copy + own[k:])))
    repeated = {i for i, _ in rows}
    rows += [(1000 + k, " ".join(word() for _ in range(300))) for k in range(60)]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id for r in got} == repeated
    kept = {r.doc_id for r in got if r.kept}
    assert kept and kept < repeated and all(r.run_words >= 51 for r in got)


def test_documents_with_shared_passages_are_all_found(spark):
    docs = C.table(spark, SF_SMALL, "documents")
    own = defaultdict(set)
    for r in docs.collect():
        w = r.text.lower().split()
        for k in range(len(w) - 50):
            own[tuple(w[k:k + 51])].add(r.doc_id)
    want = {i for s in own.values() if len(s) > 1 for i in s}
    assert want and want == {r.doc_id for r in repeated_passages(docs).collect()}


def test_passages_of_odd_rows(odd, empty):
    got = {(r.doc_id, r.kept) for r in repeated_passages(odd, min_run=1).collect()}
    assert {i for i, _ in got} == {None, 1, 2, 4}
    assert repeated_passages(empty).count() == 0


@pytest.mark.parametrize("plate, others", [(11, 500), (13, 300)])
def test_near_copies_that_share_boilerplate_are_linked(spark, monkeypatch, plate, others):
    monkeypatch.setattr(para_dedup, "BLOCK", 64)
    rnd = random.Random(plate)
    word = lambda: f"w{rnd.randrange(10 ** 9)}"
    common = [f"p{k}" for k in range(plate)]
    rows = []
    for _ in range(80):  # paragraphs of 12 shingles, plate - 4 of them frequent; Jaccard 11 / 13
        text = common + [word() for _ in range(16 - plate)]
        rows += [(len(rows) + k, " ".join(text[:-1] + [word()])) for k in range(2)]
    rows += [(len(rows) + k, " ".join(common + [word() for _ in range(16 - plate)])) for k in range(others)]
    low = {i: name for (i, _), (_, _, name) in zip(rows, brute(rows))}
    often = Counter(low.values())
    want = {(i, int(name)) for i, name in low.items() if often[name] > 1}
    assert len(want) == 160
    rnd.shuffle(rows)
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), min_run=1).collect()
    assert {(r.doc_id, r.keep_id) for r in got} == want


def test_passages_of_just_over_fifty_words_are_all_found(spark):
    rnd = random.Random(51)
    word = lambda: f"w{rnd.randrange(10 ** 9)}"
    rows = []
    for size in list(range(51, 60)) * 40:
        passage = [word() for _ in range(size)]
        for _ in range(2):
            own = [word() for _ in range(rnd.randint(60, 160))]
            k = rnd.randrange(len(own) + 1)
            rows.append((len(rows), " ".join(own[:k] + passage + own[k:])))
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {i for i, _ in rows} - {r.doc_id for r in got} == set()


def test_shorter_common_stretches_are_left_alone(spark):
    rnd = random.Random(50)
    word = lambda: f"w{rnd.randrange(10 ** 9)}"
    rows = []
    for size in list(range(20, 51, 3)) * 10:
        passage = [word() for _ in range(size)]
        for _ in range(3):
            own = [word() for _ in range(rnd.randint(60, 160))]
            k = rnd.randrange(len(own) + 1)
            rows.append((len(rows), " ".join(own[:k] + passage + own[k:])))
    long = [word() for _ in range(51)]
    at = len(rows)  # a passage of 51 words in two documents, 30 of them in an earlier third one
    rows += [(at, " ".join([word() for _ in range(80)] + long[10:40])),
             (at + 1, " ".join([word() for _ in range(80)] + long)), (at + 2, " ".join(long + [word() for _ in range(80)]))]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id for r in got} == {at + 1, at + 2}
    assert {r.keep_id for r in got} == {at + 1} and {r.run_words for r in got} == {51}
