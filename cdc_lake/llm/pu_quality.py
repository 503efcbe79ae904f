"""Quality scores by positive-unlabelled learning (operator 10).

Trusted positives are documents labelled good outside the held-out fold; everything else is unlabelled web text.
The class prior (share of good text) is the share of good ones among the labels outside the held-out fold.  An
additive logistic model over binned text statistics minimises the non-negative unbiased risk

    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)]):

when the second term turns negative on the fitting rows, the step goes the other way, which stops the model from
explaining single unlabelled rows.  Labelled negatives serve for the prior only.

The fit uses bounded samples (``FIT_ROWS`` positives and as many unlabelled rows, chosen by hash); every row is
scored from its whole text alone.

Cases: null and empty texts have all statistics zero and are scored like any text; without positive labels every
score is 0; repeated rows are scored each; a null doc_id counts as held out.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

FIT_ROWS = 20_000
BINS = 16
THRESHOLD = 0.3
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"
MARKS = b".,;:'\"()-?"
SYMBOLS = bytes(b for b in range(33, 127) if b not in UPPER + LOWER + DIGITS + MARKS)


def statistics(text: str) -> list[float]:
    """Statistics of a whole text, all near [0, 1] except the first."""
    raw = text.encode()
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * 14

    def share(chars: bytes) -> float:
        return (size - len(raw.translate(None, chars))) / size

    count = Counter(words)
    lines = [x for x in text.split("\n") if x]
    distinct_lines = len(set(lines))
    same = sum(map(bytes.__eq__, words, words[1:]))
    top = count.most_common(3)
    upper, lower = share(UPPER), share(LOWER)
    return [math.log1p(n) / 10, size / n / 20, upper / (upper + lower + 1e-9), share(DIGITS), share(SYMBOLS),
            share(MARKS), same / n, len(count) / n, len(count) / n ** 0.8, top[0][1] / n,
            sum(k for _, k in top) / n, distinct_lines / max(1, len(lines)), math.log1p(n / max(1, len(lines))) / 6,
            count[b"|"] / n]


NAMES = 14


def _stats(rows: DataFrame, keep: str, kind: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            f = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(keep), pa.array(f, pa.list_(pa.float64()))], [keep, "f"])

    return rows.select(keep, "text").mapInArrow(run, f"{keep} {kind}, f array<double>")


def edges(x: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Inner bin borders (quantiles) per statistic."""
    return np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0).T


def binned(x: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Column numbers of a one-hot coding, one per statistic."""
    width = borders.shape[1] + 1
    return np.column_stack([np.searchsorted(borders[k], x[:, k], side="right") + k * width
                            for k in range(x.shape[1])])


def nnpu(pos: np.ndarray, unl: np.ndarray, width: int, prior: float, steps: int = 1000, rate: float = 0.1,
         ridge: float = 3e-5, beta: float = 0.0) -> tuple[float, np.ndarray]:
    """Bias and weights minimising the non-negative risk; rows are column numbers of ones.  Adam, full batch."""
    w, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    w[-1] = math.log(prior / (1 - prior))

    def pull(cols, g):
        out = np.bincount(cols.ravel(), np.repeat(g, cols.shape[1]), width + 1)
        out[-1] = g.sum()
        return out

    for t in range(1, steps + 1):
        fp, fu = w[pos].sum(1) + w[-1], w[unl].sum(1) + w[-1]
        sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        g_neg = pull(unl, su / len(su)) - prior * pull(pos, sp / len(sp))
        if negative >= -beta:
            g = prior * pull(pos, (sp - 1) / len(sp)) + g_neg
        else:
            g = -g_neg
        g[:-1] += ridge * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return float(w[-1]), w[:-1]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
        fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, float, np.ndarray] | None:
    """(bin borders, bias, weights), or None without positive labels."""
    known = C.written(C.labelled(labels, label, id_col), "labelled")
    size = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not size.get(1):
        return None
    prior = min(0.99, max(0.01, size[1] / sum(size.values())))
    rows = docs.select(F.col(id_col).alias("doc_id"), C.text_of(text_col).alias("text"))
    chosen = F.broadcast(C.hash_sample(known.where("y = 1"), "doc_id", fit_rows, size[1]))  # about fit_rows rows
    trusted = rows.join(chosen, "doc_id").select(F.lit(1).alias("y"), "text")
    web = C.hash_sample(rows, "doc_id", fit_rows, rows.count()).select(F.lit(0).alias("y"), "text")
    got = _stats(trusted.unionByName(web), "y", "int").toPandas()  # about 2 * fit_rows rows of 14 numbers
    if not len(got) or not (got["y"] == 1).any():
        return None
    x, y = np.array(got["f"].tolist()), got["y"].to_numpy()
    borders = edges(x[y == 0])
    cols = binned(x, borders)
    bias, w = nnpu(cols[y == 1], cols[y == 0], NAMES * BINS, prior)
    return borders, bias, w


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (score >= 0.3)."""
    model = fit(docs, labels, id_col, text_col, label, fit_rows)
    rows = docs.select(F.col(id_col).alias("doc_id"), C.text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            score = np.zeros(batch.num_rows)
            if model is not None and batch.num_rows:
                borders, bias, w = model
                x = np.array([statistics(t) for t in batch.column("text").to_pylist()])
                score = 1 / (1 + np.exp(-(w[binned(x, borders)].sum(1) + bias)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64())],
                                             ["doc_id", "score"])

    out = rows.mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", (C.fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
