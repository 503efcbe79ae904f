"""Exact dedup, decontamination and k-d shards: odd rows and brute force."""

import random
from collections import defaultdict

from cdc_lake.llm import common as C
from cdc_lake.llm.decontaminate import drop_leaking, leaks
from cdc_lake.llm.exact_dedup import drop_copies, exact_dedup
from cdc_lake.llm.kd_shards import kd_shards

from .conftest import ODD, SF_SMALL, bag

LOWER = str.maketrans(C.UPPER, C.UPPER.lower())


def test_exact_dedup_odd_rows(odd):
    groups = defaultdict(list)
    for i, t in ODD:
        groups[(t or "").translate(LOWER)].append(i)
    got = exact_dedup(odd).collect()
    assert len(got) == len(ODD)
    want = sorted((str(i), str(max((x for x in g if x is not None), default=None)), len(g)) for g in groups.values() for i in g)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_filter_crowded_and_joined(odd):
    # Two bits per row make most rows possibly repeated; no broadcast space makes the filter a shuffle join.
    usual = bag(exact_dedup(odd), "doc_id", "keep_id", "group_size", "kept")
    assert bag(exact_dedup(odd, bits_per_row=1, broadcast_bytes=0), "doc_id", "keep_id", "group_size", "kept") == usual


def test_drop_copies(odd, empty):
    got = drop_copies(odd)
    assert got.columns == odd.columns
    assert bag(got, "doc_id") == [(2,), (3,), (4,), (5,), (6,), (7,), (8,)]
    assert drop_copies(empty).count() == 0 and exact_dedup(empty).count() == 0


def _shingles(text, n):
    w = (text or "").translate(LOWER).encode().split()
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}


def test_leaks_equal_brute_force(spark):
    docs, items = (C.table(spark, SF_SMALL, t) for t in ("documents", "benchmark"))
    text = defaultdict(set)
    for r in docs.collect():
        text[r.doc_id] |= _shingles(r.text, 5)
    want = set()
    for r in items.collect():
        s = _shingles(r.text, 5)
        want |= {(d, r.item_id) for d, t in text.items() if s and len(s & t) >= 0.75 * len(s)}
    assert want and {(r.doc_id, r.item_id) for r in leaks(docs, items).collect()} == want


def test_leaks_with_repeated_and_null_ids(spark):
    """Every item row is an item of its own, every text of a doc_id a document of its own."""
    rng = random.Random(8)
    text = lambda n: " ".join(f"w{rng.randrange(60)}" for _ in range(n))
    items = [(rng.choice([None, 1, 1, 2, 3]), text(rng.choice((3, 8, 30)))) for _ in range(14)]
    items += [(1, "zz yy xx"), items[0], (None, None), (None, "")]
    docs = []
    for n in range(40):
        parts = [text(20), *(rng.choice(items)[1] or "" for _ in range(rng.randrange(3))), text(20)]
        docs.append((rng.choice([None, 5, 5, 6, *range(10, 30)]), " ".join(parts)))
    docs += [docs[0], (5, "zz yy xx"), (5, None), (None, text(3))]
    want, hit = [], set()
    for d, t in set(docs):
        for i, s in items:
            width = min(5, len((s or "").split()))
            sh = _shingles(s, width) if width else set()
            both = len(sh & _shingles(t, width)) if width else 0
            if both and both >= 0.75 * len(sh):
                want.append((d, i, len(sh), both))
                hit.add((d, t))
    schema = "{} long, text string"
    d, i = spark.createDataFrame(docs, schema.format("doc_id")), spark.createDataFrame(items, schema.format("item_id"))
    got = leaks(d, i)
    assert got.columns == ["doc_id", "item_id", "item_shingles", "matched", "containment"]
    key = lambda r: [(x is not None, x) for x in r]
    assert bag(got, "doc_id", "item_id", "item_shingles", "matched") == sorted(want, key=key)
    assert bag(drop_leaking(d, i), "doc_id", "text") == sorted([r for r in docs if r not in hit], key=key)


def test_leaks_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "BETA gamma delta EPSILON zeta", "q"), (2, "x", "q"), (3, None, "q"), (4, "", "q"),
                                   (None, "gamma delta", "q"), (5, "not there at all really", "q")],
                                  "item_id long, text string, h string")
    assert bag(leaks(odd, items), "doc_id", "item_id") == sorted(
        [(None, None), (None, 1), (1, None), (1, 1), (2, None), (2, 1), (4, 2)], key=lambda r: [(x is not None, x) for x in r])
    assert leaks(empty, items).count() == 0 and leaks(odd, items.limit(0)).count() == 0
    kept = drop_leaking(odd, items)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {None, 2, 3, 5, 6, 7, 8}
    assert bag(kept.where("doc_id = 2 OR doc_id IS NULL"), "text") == [(None,), (None,)]  # other texts of these ids stay


def test_partial_containment_at_the_threshold(spark):
    item = " ".join(f"w{k}" for k in range(24))  # 20 shingles: 15 are enough
    docs = spark.createDataFrame([(k, "start " * 300 + " ".join(f"w{j}" for j in range(k + 4)) + " end" * 300)
                                  for k in (13, 14, 15, 20)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert bag(leaks(docs, items), "doc_id", "matched") == [(15, 15), (20, 20)]


def test_kd_shards_law(spark, odd, empty):
    docs = C.table(spark, SF_SMALL, "documents")
    rows = kd_shards(docs).collect()
    assert len(rows) == docs.count() and {r.law for r in rows} == {"bytes"}
    size, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    total, largest = sum(size.values()), max(r.size for r in rows)
    assert set(size) == set(range(8)) and all(abs(s - total / 8) <= 2 * largest for s in size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    got = kd_shards(odd, shards=3).collect()
    assert len(got) == len(ODD) and all(0 <= r.shard < 3 and r.grown_shard is None for r in got)
    assert sorted(r.size for r in got) == sorted(len((t or "").encode()) + 1 for _, t in ODD)
    assert kd_shards(empty).count() == 0


def test_kd_shards_split_a_text_of_very_many_copies(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN 'one and the same text' "
                                        "ELSE concat('text number ', id, ' of its own') END AS text")
    size = defaultdict(int)
    of = defaultdict(set)
    for r in kd_shards(docs, shards=5).collect():
        size[r.shard] += r.size
        of[r.text_crc32].add(r.shard)
    mean = sum(size.values()) / 5
    assert all(abs(s - mean) < 0.1 * mean for s in size.values())
    assert sum(len(s) > 1 for s in of.values()) == 1  # only the heavy group is split


def test_kd_target_bytes(spark):
    docs = spark.range(100).selectExpr("id AS doc_id", "repeat('z', 99) || id AS text")
    assert len({r.shard for r in kd_shards(docs, target_bytes=2_000).collect()}) == 6


def test_kd_shards_with_a_text_in_the_place_of_n_chars(spark):
    docs = spark.createDataFrame([(k, "w " * (k % 7), "many") for k in range(40)], "doc_id long, text string, n_chars string")
    got = kd_shards(docs, shards=4).collect()
    assert sorted(r.doc_id for r in got) == list(range(40)) and {r.shard for r in got} == {0, 1, 2, 3}
    plain = kd_shards(docs.drop("n_chars"), shards=4).collect()
    assert sorted((r.doc_id, r.shard) for r in got) == sorted((r.doc_id, r.shard) for r in plain)
