"""Katz scores against a plain Python model; the model sums to one."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cdc_lake.llm import common as C
from cdc_lake.llm.katz import K, Unigrams, discounted, discounts, katz_scores, pack, unpack

from .conftest import ODD, SF_SMALL


class Plain:
    """A dictionary model of (id, text) rows."""

    def __init__(self, rows):
        self.uni, self.pair, self.after = Counter(), Counter(), defaultdict(set)
        for i, t in rows:
            if not self.held(i):
                words = self.tokens(t)
                self.uni.update(words)
                for h, w in zip(["<s>", *words], words):
                    self.pair[h, w] += 1
                    self.after[h].add(w)
        self.total = sum(self.uni.values())
        self.du, self.dp = self.found(self.uni), self.found(self.pair)
        self.context = Counter()
        for (h, _), n in self.pair.items():
            self.context[h] += n
        self.unknown = 1 - sum(self.cut(n, self.du) for n in self.uni.values()) / self.total if self.total else 1.0
        self.backoff = {}

    @staticmethod
    def held(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0

    @staticmethod
    def tokens(t):
        return [*(t or "").encode().lower().split(), "</s>"]

    @staticmethod
    def found(counts):
        n = Counter(counts.values())
        return discounts([0, *(n[k] for k in range(1, K + 2))])

    @staticmethod
    def cut(n, d):
        return n - 0.5 if n > K else d[n] * n

    def lower(self, w):
        return self.cut(self.uni[w], self.du) / self.total if w in self.uni else self.unknown

    def p(self, h, w):
        if (h, w) in self.pair:
            return self.cut(self.pair[h, w], self.dp) / self.context[h]
        if h not in self.context:
            return self.lower(w)
        if h not in self.backoff:
            seen = self.after[h]
            self.backoff[h] = ((1 - sum(self.cut(self.pair[h, x], self.dp) for x in seen) / self.context[h])
                               / (1 - sum(map(self.lower, seen))))
        return self.backoff[h] * self.lower(w)

    def row(self, i, t):
        words = self.tokens(t)
        score = sum(math.log10(self.p(h, w)) for h, w in zip(["<s>", *words], words))
        base = sum(math.log10((self.uni[w] + 0.1) / (self.total + 0.1 * (len(self.uni) + 1))) for w in words)
        return self.held(i), len(words), sum(w in self.uni for w in words), self.total, base, score


def _check(rows, got):
    model = Plain(rows)
    want = sorted(((str(i), *model.row(i, t)) for i, t in rows), key=lambda r: (r[0], r[2], r[5]))
    have = sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got),
                  key=lambda r: (r[0], r[2], r[5]))
    assert len(want) == len(have)
    for w, g in zip(want, have):
        assert w[:5] == g[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    return model


def test_scores_equal_plain_model(spark):
    docs = C.table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model = _check(rows, katz_scores(docs).collect())
    for h in [*list(model.context)[:20], "<s>"]:  # exactly normalised, unknown word included
        assert sum(model.p(h, w) for w in model.uni) + model.p(h, "no such word") == pytest.approx(1, abs=1e-9)


def test_many_small_batches(spark):
    docs = C.table(spark, SF_SMALL, "documents").repartition(5)
    a = {r.doc_id: r.score for r in katz_scores(docs, batch_tokens=2000).collect()}
    b = {r.doc_id: r.score for r in katz_scores(docs).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-9) for k in a)


def test_history_of_a_third_of_all_tokens(spark):
    rows = [(i, " ".join(f"the w{(7 * i + k) % 150}" if k % 2 else "the the" for k in range(60))) for i in range(80)]
    _check(rows, katz_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())


def test_odd_rows(spark, odd, empty):
    _check(ODD, katz_scores(odd).collect())
    assert katz_scores(empty).count() == 0
    held = [(i, "only held out") for i in range(200) if Plain.held(i)]
    got = katz_scores(spark.createDataFrame(held, "doc_id long, text string")).collect()
    assert all(r.held_out and r.train_tokens == 0 and r.score == 0 and r.n_known == 0 for r in got)


def test_pack_round_trip():
    rng = np.random.default_rng(1)
    for x in (np.zeros(0, np.int64), np.sort(rng.integers(0, 2 ** 63, 500).astype(np.uint64)), rng.integers(0, 9, 100, np.int32),
              rng.random(50)):
        for s in (False, True):
            if not (s and x.dtype.kind == "f"):
                assert np.array_equal(unpack(pack(x, s)), x)


def test_discounts_keep_mass_for_the_unseen():
    for n in ([0, 0, 0, 0, 0, 0, 0], [0, 10, 0, 0, 0, 0, 0], [0, 100, 40, 22, 13, 9, 6], [0, 1, 9, 1, 9, 1, 9]):
        d = discounts(n)
        assert all(0 < x < 1 for x in d[1:])
        assert discounted(np.array([0, 1, K + 1]), d)[2] == K + 0.5
    assert Unigrams(0, 0, [0] * (K + 2)).unknown == 1.0
