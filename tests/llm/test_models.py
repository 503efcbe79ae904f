"""Toxicity and quality: automaton against edit distance, held-out accuracy, odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdc_lake.llm import common as C
from cdc_lake.llm.pu_quality import NAMES, binned, edges, nnpu, quality, statistics
from cdc_lake.llm.toxicity import Automaton, Matcher, drop_toxic, edits_allowed, toxicity

from .conftest import ODD

SF = "/root/testdata/sf0.01"


def distance(a, b):
    """Edits with swaps of neighbours."""
    d = [[max(i, j) if 0 in (i, j) else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_equals_edit_distance():
    rnd = random.Random(2)
    for _ in range(150):
        terms = {"".join(rnd.choice("ab") for _ in range(rnd.randint(3, 9))): rnd.random() + 1 for _ in range(5)}
        auto = Automaton(terms)
        for _ in range(50):
            word = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 10)))
            want = min(((distance(t, word), -x, t) for t, x in terms.items() if distance(t, word) <= edits_allowed(t)),
                       default=None)
            assert auto.match(word) == (want and (want[2], want[0]))


def test_stems_and_rigid_terms():
    auto = Automaton({"vile*": 2.0, "dreadful": 3.0, "nasty": 2.0}, frozenset({"nasty"}))
    assert auto.match("vileness") == ("vile*", 0) and auto.match("vile") == ("vile*", 0) and auto.match("vila") is None
    assert auto.match("draedfull") == ("dreadful", 2) and auto.match("nastyy") is None and auto.match("nasty") == ("nasty", 0)


def test_quotations_count_less():
    m = Matcher({"dreadful": 4.0})
    use = m.features("you are a dreadful dreadfull writer, no doubt about it")
    told = m.features('he said "a dreadful dreadfull writer" about it, no doubt')
    assert use[0] > told[0] > 0 and use[2] > told[2] == 0
    assert m.features("") == [0, 0, 0] and m.features("a fine day") == [0, 0, 0]


@pytest.fixture(scope="module")
def labels(spark):
    return C.table(spark, SF, "labels")


def _accuracy(df, labels, label):
    got = df.join(labels, "doc_id").where("held_out").agg(
        F.avg((F.col("predicted") == F.col(label)).cast("int")).alias("a"),
        F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert 0 <= got.lo <= got.hi <= 1
    return got.a


def test_toxicity_held_out(spark, labels):
    docs = C.table(spark, SF, "documents")
    assert _accuracy(toxicity(docs, labels), labels, "toxic") >= 0.93


def test_misspelled_and_quoted_terms(spark, labels):
    docs = C.table(spark, SF, "documents")
    extra = spark.createDataFrame([
        (900_001, "you are a complete idiott and a patheticc loser, you stuupid worthles clown", "en", "x", 0),
        (900_002, "the weather was fine and the harvest was good this year", "en", "x", 0)], docs.schema)
    got = {r.doc_id: r.predicted for r in toxicity(docs.unionByName(extra), labels).where("doc_id > 900000").collect()}
    assert got == {900_001: 1, 900_002: 0}
    kept = drop_toxic(docs.unionByName(extra), labels)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.where("doc_id > 900000").collect()] == [900_002]


def test_quality_held_out(spark, labels):
    assert _accuracy(quality(C.table(spark, SF, "documents"), labels), labels, "quality") >= 0.9


@pytest.mark.parametrize("score", [toxicity, quality])
def test_odd_rows(spark, odd, empty, labels, score):
    known = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (2, 1, 0), (3, None, None), (None, 1, 1), (4, 0, 1), (6, 1, 0), (7, 1, 0)],
                                  "doc_id long, quality int, toxic int")
    for lab in (known, known.limit(0)):
        got = score(odd, lab).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ODD)
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) and r.held_out is not None for r in got)
    assert score(empty, known).count() == 0


def test_statistics_take_any_text():
    for _, t in ODD:
        x = statistics(t or "")
        assert len(x) == NAMES and np.isfinite(x).all()


def test_nnpu_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(0)
    pos = rng.normal(1, 0.5, (800, 2))
    unl = np.concatenate((rng.normal(1, 0.5, (900, 2)), rng.normal(-1, 0.5, (300, 2))))
    borders = edges(unl)
    bias, w = nnpu(binned(pos, borders), binned(unl, borders), 32, 0.75)
    score = w[binned(unl, borders)].sum(1) + bias
    assert ((score > 0) == (np.arange(1200) < 900)).mean() > 0.95
