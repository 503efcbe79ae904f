"""Registered queries: SQL oracles, the pipeline against plain Python, and the entry without the subpackage."""

import pytest

from cdc_lake.llm import common as C
from cdc_lake.llm.queries import ORACLE, QUERIES

from .conftest import SF_SMALL
from .test_exact import LOWER, _shingles
from .test_near import shingle_set


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    from tools.oracle_check import canon, duck

    df = QUERIES[name](spark, SF_SMALL)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    r = duck(SF_SMALL).execute(ORACLE[name])
    assert got == canon([c[0] for c in r.description], r.fetchall())


def test_one_query_per_operator():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}


def test_pipeline_equals_plain_steps(spark):
    import corpus_pipeline as P
    from cdc_lake.llm.bpe import Codec
    from cdc_lake.llm.toxicity import toxicity

    docs, labels = C.table(spark, SF_SMALL, "documents"), C.table(spark, SF_SMALL, "labels")
    clean = {r.doc_id for r in toxicity(docs, labels).where("predicted = 0").collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in clean)
    last = {(t or "").translate(LOWER): (i, t) for i, t in rows}
    rows = sorted(last.values())
    sets = {i: shingle_set(t) for i, t in rows}
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 100 * both >= 75 * len(sets[a] | sets[b]) and group[a] != group[b]:
                lo, hi = sorted((group[a], group[b]))
                group = {k: lo if v == hi else v for k, v in group.items()}
    rows = [(i, t) for i, t in rows if group[i] == i]
    items = [s for r in C.table(spark, SF_SMALL, "benchmark").collect() if (s := _shingles(r.text, 5))]
    rows = [(i, t) for i, t in rows if not any(len(s & _shingles(t, 5)) >= 0.75 * len(s) for s in items)]
    with open(C.vocabulary("byte_bpe_50k.json"), encoding="utf-8") as f:
        codec = Codec(f.read())
    want = sorted((i, len(codec.tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    got = sorted((r.doc_id, r.n_tokens) for r in P.run(spark, SF_SMALL).collect())
    assert want and got == want


def test_stages_take_odd_rows(spark, odd):
    import corpus_pipeline as P

    docs = odd.select("doc_id", "text", odd["h"].alias("lang"), "source", odd["n"].cast("long").alias("n_chars"))
    for d in (docs, docs.limit(0)):
        for _, stage in P.STAGES[:-1]:
            d = C.written(stage(spark, d, SF_SMALL), "test-stage")
            assert d.columns == docs.columns
        P.STAGES[-1][1](spark, d, SF_SMALL).collect()
