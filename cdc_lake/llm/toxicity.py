"""Toxicity scores from a learned lexicon matched by Levenshtein automata (operator 8).

*Lexicon.*  From labelled rows outside the held-out fold: words, and word beginnings ("stem*", for inflected forms),
that are many times more frequent in documents labelled toxic, by document frequency.  At most ``MAX_TERMS`` terms.

*Matching.*  The terms form a trie.  Each term accepts words within 0, 1 or 2 edits (insert, delete, replace, swap of
neighbours) by its length.  The product of trie and Levenshtein automata is determinised lazily: a word is read once,
character by character, and nearly every word of clean text ends in the dead state after a few characters.

*Context.*  A match counts less when its window shows a quotation: it stands between quotation marks, or near a word
of reporting.  Evidence of a document: the sum over matches of log-odds, less for edits, less in quotations.

*Score.*  A logistic model of the evidence, its density and the number of distinct terms, fitted on a bounded sample
of labelled rows (``FIT_ROWS``, chosen by hash); its weights are kept non-negative, so more evidence never lowers a score.
Inputs are the text alone.

Cases: null and empty texts have no evidence; without toxic labels every score is 0; every row is scored, also
repeated ones; a null doc_id counts as held out.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

FIT_ROWS = 40_000
MAX_TERMS = 1_000
MIN_LOG_ODDS = 3.0
QUOTED = 0.25
WINDOW = 6
#: Words around a match that mark a mention rather than a use (fixed list).
REPORTING = frozenset("said says called quoted quote quotes word words term slur insult insulting cited wrote "
                      "reported definition meaning phrase".split())
OPENING, CLOSING = "\"'“‘«„`(", "\"'”’»“`)"
EDGE = ".,;:!?…\"'“”‘’«»„`()[]{}<>*_-"


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Automaton:
    """Lazily determinised product of a lexicon trie and the terms' Levenshtein automata.

    ``match(word)`` gives the best (term, edits) or None.  A term ending in ``*`` matches every word that begins
    with it, without edits.  Items of a state: (node, edits, pending), pending being the letter that completes a swap.
    """

    LIMIT = 100_000  # states kept before the table is rebuilt

    def __init__(self, terms: dict[str, float], rigid: frozenset[str] = frozenset()):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.budget = [0]  # most edits of any term below a node
        for t in sorted(terms):
            node, left = 0, 0 if t.endswith("*") or t in rigid else edits_allowed(t)
            self.budget[0] = max(self.budget[0], left)
            for c in t.rstrip("*"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.word.append(None)
                    self.stem.append(None)
                    self.budget.append(0)
                node = self.children[node][c]
                self.budget[node] = max(self.budget[node], left)
            (self.stem if t.endswith("*") else self.word)[node] = t
        self.rigid = rigid
        self._reset()

    def _reset(self) -> None:
        self.table: list[dict[str, int]] = []
        self.accept: list[tuple[str, int] | None] = []
        self.number: dict[frozenset, int] = {}
        self.items: list[frozenset] = []
        self.start = self._state(self._closure({(0, 0, "")}))

    def _closure(self, items: set) -> frozenset:
        """With missing letters of the word (deletions) added."""
        todo = list(items)
        while todo:
            node, e, pending = todo.pop()
            if pending or node < 0:
                continue
            for child in self.children[node].values():
                new = (child, e + 1, "")
                if e + 1 <= self.budget[child] and new not in items:
                    items.add(new)
                    todo.append(new)
        return frozenset(items)

    def _state(self, items: frozenset) -> int:
        if items not in self.number:
            self.number[items] = len(self.items)
            self.items.append(items)
            self.table.append({})
            best = None
            for node, e, pending in items:
                term = None if pending else self.stem[-node] if node < 0 else self.word[node] or self.stem[node]
                if term is None or e > (0 if term.endswith("*") or term in self.rigid else edits_allowed(term)):
                    continue
                if best is None or (e, -self.terms[term], term) < (best[1], -self.terms[best[0]], best[0]):
                    best = (term, e)
            self.accept.append(best)
        return self.number[items]

    def _step(self, state: int, c: str) -> int:
        out = set()
        for node, e, pending in self.items[state]:
            if node < 0:
                out.add((node, e, ""))
                continue
            if pending:
                if c == pending:
                    out.add((node, e, ""))
                continue
            if e == 0 and self.stem[node]:
                out.add((-node, 0, ""))
            if e + 1 <= self.budget[node]:
                out.add((node, e + 1, ""))
            for a, child in self.children[node].items():
                if a == c:
                    out.add((child, e, ""))
                elif e + 1 <= self.budget[child]:
                    out.add((child, e + 1, ""))
                    below = self.children[child].get(c)
                    if below is not None and e + 1 <= self.budget[below]:
                        out.add((below, e + 1, a))
        return self._state(self._closure(out))

    def match(self, word: str) -> tuple[str, int] | None:
        if len(self.items) > self.LIMIT:
            self._reset()
        s, table, items = self.start, self.table, self.items
        for c in word:
            n = table[s].get(c)
            if n is None:
                n = table[s][c] = self._step(s, c)
            s = n
            if not items[s]:
                return None
        return self.accept[s]


def bare(token: str) -> str:
    return token.strip(EDGE)


class Matcher:
    """Evidence of texts under a lexicon."""

    CACHE = 200_000

    def __init__(self, terms: dict[str, float], rigid: frozenset[str] = frozenset()):
        self.auto, self.terms = Automaton(terms, rigid), terms
        self.cache: dict[str, tuple[str, int] | None] = {}

    def of(self, token: str):
        got = self.cache.get(token, 0)
        if got == 0:
            if len(self.cache) > self.CACHE:
                self.cache.clear()
            got = self.cache[token] = self.auto.match(bare(token))
        return got

    def hits(self, text: str) -> tuple[list[tuple[str, int, bool]], int]:
        """(term, edits, quoted) of every matching token, and the number of tokens."""
        tokens = text.lower().split()
        found = {t: m for t in set(tokens) if (m := self.of(t))}
        if not found:
            return [], len(tokens)
        return [(*found[t], self.quoted(tokens, i)) for i, t in enumerate(tokens) if t in found], len(tokens)

    @staticmethod
    def quoted(tokens: list[str], i: int) -> bool:
        """Is token ``i`` between quotation marks within its window, or beside a word of reporting?"""
        lo, hi = max(0, i - WINDOW), min(len(tokens), i + WINDOW + 1)
        opens = any(tokens[k][0] in OPENING for k in range(lo, i + 1))
        closes = any(bare(tokens[k]) != tokens[k] and tokens[k].rstrip(".,;:!?")[-1:] in CLOSING and
                     tokens[k].rstrip(".,;:!?")[-1:] != "" for k in range(i, hi))
        return opens and closes or any(bare(tokens[k]) in REPORTING for k in range(lo, hi))

    def features(self, text: str) -> list[float]:
        hits, n = self.hits(text)
        evidence = sum(self.terms[t] * (1 - 0.25 * e) * (QUOTED if q else 1.0) for t, e, q in hits)
        distinct = len({t for t, _, q in hits if not q})
        return [math.log1p(evidence), math.log1p(100 * evidence / (n + 20)), math.log1p(distinct)]


def _terms_of(text: str, stems: bool = True) -> set[str]:
    words = {w for w in map(bare, set(text.lower().split())) if len(w) >= 3 and not w.isdigit()}
    if not stems:
        return words
    return words | {w[:k] + "*" for w in words for k in range(4, min(len(w), 9) + 1)}


def _counted(rows: DataFrame, wanted=None) -> DataFrame:
    """(term, n): document frequencies of the terms of ``rows`` (text), of ``wanted`` (broadcast set) only if given."""
    def count(batches):
        for batch in batches:
            n: Counter[str] = Counter()
            for t in batch.column(0).to_pylist():
                n.update(_terms_of(t) if wanted is None else _terms_of(t) & wanted.value)
            yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())],
                                             ["term", "n"])

    return rows.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _without_copies(sample: DataFrame) -> DataFrame:
    """``sample`` with most copies and near copies collapsed (by the two least hashes of three-word shingles), so
    that a copied document's rare words do not look frequent."""
    def keys(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                w = text.lower().split()
                grams = {" ".join(w[i:i + 3]).encode() for i in range(max(1, len(w) - 2))}
                out.append((min(map(zlib.crc32, grams)), min(zlib.crc32(g, 1) for g in grams)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([a for a, _ in out], pa.int64()),
                                              pa.array([b for _, b in out], pa.int64())], ["y", "text", "k1", "k2"])

    return sample.mapInArrow(keys, "y int, text string, k1 long, k2 long").dropDuplicates(["y", "k1"]).dropDuplicates(
        ["y", "k2"]).select("y", "text")


def learn_lexicon(sample: DataFrame, max_terms: int = MAX_TERMS) -> dict[str, float]:
    """Terms and log-odds from ``sample`` (text, y), a written table of bounded size."""
    sample = C.written(_without_copies(sample), "tox-distinct")
    size = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic:
        return {}
    least = max(4, toxic // 200)
    # A document has a bounded share of the terms, so at most (terms per document) * 200 terms pass.
    seen = {r["term"]: r["n"] for r in _counted(sample.where("y = 1")).where(F.col("n") >= least).collect()}
    wanted = sample.sparkSession.sparkContext.broadcast(frozenset(seen))
    other = {r["term"]: r["n"] for r in _counted(sample.where("y = 0"), wanted).collect()}
    odds = {t: math.log((n + 0.5) / (toxic + 1)) - math.log((other.get(t, 0) + 0.5) / (clean + 1))
            for t, n in seen.items()}
    good = {t for t, o in odds.items() if o >= MIN_LOG_ODDS}
    # A stem of which one longer term has nine tenths of the documents says no more than that term.
    for t in sorted((t for t in good if t.endswith("*")), key=len):
        if any(u != t and u.startswith(t[:-1]) and seen[u] >= 0.9 * seen[t] for u in good):
            good.discard(t)
    best = sorted(good, key=lambda t: (-seen[t] * odds[t], t))[:max_terms]
    return {t: odds[t] for t in best}


def _rigid(sample: DataFrame, terms: dict[str, float], allowed: float = 0.002) -> frozenset[str]:
    """Terms whose misspellings also occur in clean documents: these match exactly."""
    size = sample.where("y = 0").count()

    def count(batches):
        m = Matcher(terms)
        for batch in batches:
            n: Counter[str] = Counter()
            for t in batch.column(0).to_pylist():
                n.update({x for x, e, _ in m.hits(t)[0] if e})
            yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())],
                                             ["term", "n"])

    got = sample.where("y = 0").select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(
        F.sum("n").alias("n")).collect()  # at most MAX_TERMS rows
    return frozenset(r["term"] for r in got if r["n"] > max(1, allowed * size))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, steps: int = 4000) -> np.ndarray:
    """Bias and non-negative weights by projected gradient descent."""
    x1 = np.column_stack([np.ones(len(x)), x])
    w = np.full(len(y), 1 / max(1, len(y)))
    beta = np.zeros(x1.shape[1])
    rate = 1.0 / (0.25 * float((w[:, None] * x1 * x1).sum()) + ridge)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x1 @ beta)))
        beta -= rate * 4 * (x1.T @ (w * (p - y)) + ridge * np.r_[0, beta[1:]])
        beta[1:] = np.maximum(beta[1:], 0)
    return beta


def _featured(rows: DataFrame, matcher_args, keep: str, schema: str) -> DataFrame:
    def score(batches):
        m = Matcher(*matcher_args.value)
        for batch in batches:
            f = [m.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(keep), pa.array(f, pa.list_(pa.float64()))], [keep, "f"])

    return rows.select(keep, "text").mapInArrow(score, f"{schema}, f array<double>")


class Model:
    """A fitted lexicon and its logistic weights."""

    def __init__(self, terms: dict[str, float], rigid: frozenset[str], beta: list[float]):
        self.terms, self.rigid, self.beta = terms, rigid, beta


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
        fit_rows: int = FIT_ROWS) -> Model:
    known = C.written(C.labelled(labels, label, id_col), "labelled")
    chosen = F.broadcast(C.hash_sample(known, "doc_id", fit_rows, known.count()))  # about fit_rows rows
    sample = C.written(docs.select(F.col(id_col).alias("doc_id"), C.text_of(text_col).alias("text"))
                       .join(chosen, "doc_id").select("y", "text"), "tox-sample")
    terms = learn_lexicon(sample)
    if not terms:
        return Model({}, frozenset(), [-50.0, 0, 0, 0])
    rigid = _rigid(sample, terms)
    args = docs.sparkSession.sparkContext.broadcast((terms, rigid))
    got = _featured(sample, args, "y", "y int").toPandas()  # about fit_rows rows of three numbers
    beta = fit_logistic(np.array(got["f"].tolist()), got["y"].to_numpy(float))
    return Model(terms, rigid, beta.tolist())


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label: str = "toxic", fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (score >= 0.5)."""
    model = fit(docs, labels, id_col, text_col, label, fit_rows)
    rows = docs.select(F.col(id_col).alias("doc_id"), C.text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    args = docs.sparkSession.sparkContext.broadcast((model.terms, model.rigid))
    f = _featured(rows, args, "doc_id", f"doc_id {kind}")
    z = F.lit(model.beta[0])
    for k, b in enumerate(model.beta[1:]):
        z = z + F.lit(b) * F.col("f")[k]
    score = 1 / (1 + F.exp(-z))
    return f.select("doc_id", (C.fold(F.col("doc_id"), 5) == 0).alias("held_out"), score.alias("score"),
                    (score >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) without the rows predicted toxic; repeated ids are decided row by row of text."""
    model = fit(docs, labels, id_col, text_col)
    args = docs.sparkSession.sparkContext.broadcast((model.terms, model.rigid))
    beta, names, text_at = model.beta, docs.columns, docs.columns.index(text_col)

    def keep(batches):
        m = Matcher(*args.value)
        for batch in batches:
            z = [beta[0] + sum(b * f for b, f in zip(beta[1:], m.features(t or "")))
                 for t in batch.column(text_at).to_pylist()]
            yield batch.filter(pa.array([v < 0 for v in z], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
