"""LM scoring by a Katz backoff bigram model (operator 3).

*Model.*  P(w|h) = d(r) r / c(h) for a pair seen r times, else a(h) P(w).  d are Good-Turing discounts for counts up
to K; larger counts give up half a count, so every history keeps mass for unseen words.  P(w) = d(c) c / N, and the
mass that is left is the probability of an unknown word (one type).  The backoff weight a(h) = (1 - sum of the seen
discounted shares) / (1 - sum of P over the seen words) makes every history sum to exactly one.  A history never seen
uses P(w).  Texts are scored with a begin mark as first history and one end token.

*Tables.*  A pass over the texts writes token streams: batches of about ``TOKENS`` tokens with a sorted vocabulary of
64-bit word hashes.  Counting is by request and answer, so that occurrences never move, only distinct items of a batch:

1. each batch sends its words with training counts to word buckets, which answer with the corpus counts;
2. each batch sends its distinct pairs (with the words' counts) to buckets of the history, which answer with the pair
   counts and, for histories of held-out documents, with the sums that make a(h).

Both answer tables are stored by bucket and batch; a batch then evaluates its tokens.  A word or pair that holds a
third of the corpus is one item per batch.  A history with more than half a bucket's share of tokens is spread over
several buckets by its next word; its sums (of at most two histories per bucket) are combined and sent to all tasks.
The number of buckets follows the number of tokens.

Words are told apart by 64-bit hashes, next words of one history by 48 bits.

Cases: null texts are empty (one token, the end); without training tokens every probability is 1; repeated rows are
scored and counted each; a null doc_id counts as empty text, so it is held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import wordhash as H

K = 5
TOKENS = 1_000_000
BUCKET_TOKENS = 1_500_000
MIN_BUCKETS = 48
END = H.U(0xE7D0E7D0E7D0E7D1)
BEGIN = H.U(0xBE61BE61BE61BE63)
ANSWER = "bucket int, batch long, kind int, a binary, b binary, c binary"
MASK48 = H.U((1 << 48) - 1)


# -- packed arrays ---------------------------------------------------------------------------------------------------

def pack(x: np.ndarray, sorted_: bool = False) -> bytes:
    """An integer or float array as compressed byte planes; sorted arrays as differences."""
    import zstandard

    x = np.ascontiguousarray(x)
    kind = x.dtype.str[1:]
    if sorted_ and len(x):
        x = np.concatenate((x[:1], np.diff(x)))
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T
    return kind.encode() + bytes([sorted_]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    import zstandard

    kind, sorted_ = np.dtype(data[:2].decode()), data[2]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[3:]), np.uint8)
    x = np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)
    return np.cumsum(x, dtype=kind) if sorted_ else x


# -- discounts -------------------------------------------------------------------------------------------------------

def discounts(n: list[int]) -> np.ndarray:
    """Good-Turing discounts d(0..K) (d(0) unused) from n[1..K+1], the numbers of types with each count.

    Where the counts of counts give no discount strictly between 0 and 1, half a count is given up instead.
    """
    d = np.ones(K + 1)
    n1 = n[1] if len(n) > 1 else 0
    common = (K + 1) * n[K + 1] / n1 if n1 else 1.0
    for r in range(1, K + 1):
        value = -1.0
        if n[r] and common != 1:
            value = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)
        d[r] = value if 0 < value < 1 else (r - 0.5) / r
    return d


def discounted(count: np.ndarray, d: np.ndarray) -> np.ndarray:
    """d(r) * r; 0 for 0."""
    count = np.asarray(count)
    return np.where(count > K, count - 0.5, d[np.minimum(count, K)] * count)


class Unigrams:
    """Global figures of the training tokens: N, V, discounts and the unknown word's probability."""

    def __init__(self, total: int, types: int, n: list[int]):
        self.total, self.types, self.d = total, types, discounts(n)
        kept = sum(float(discounted(np.array([r]), self.d)[0]) * n[r] for r in range(1, K + 1))
        large = types - sum(n[1:K + 1])
        kept += total - sum(r * n[r] for r in range(1, K + 1)) - 0.5 * large
        self.unknown = 1 - kept / total if total else 1.0

    def p(self, count: np.ndarray) -> np.ndarray:
        if not self.total:
            return np.ones(len(count))
        return np.where(count > 0, discounted(count, self.d) / self.total, self.unknown)


def _counts_of_counts(count: np.ndarray) -> list[int]:
    """[tokens, types, n(1), .., n(K+1)] of positive counts."""
    count = count[count > 0]
    small = np.bincount(count[count <= K + 1], minlength=K + 2)[:K + 2]
    return [int(count.sum()), len(count), *small[1:].tolist()]


# -- batches ---------------------------------------------------------------------------------------------------------

def streams(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10,
            batch_tokens: int = TOKENS) -> DataFrame:
    """Token streams, one row per batch: batch, doc_ids, held, lengths, vocab (sorted hashes), ids (into vocab)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), (C.fold(F.col(id_col), folds) == 0).alias("held"),
                       F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["batch", "doc_ids", "held", "lengths", "vocab", "ids"]

    def run(batches):
        from pyspark import TaskContext

        number, have = TaskContext.get().partitionId() << 32, 0
        ids, held, hashes, lengths, type_ = [], [], [], [], None

        def flush():
            vocab, local = np.unique(np.concatenate(hashes), return_inverse=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([sum(ids, [])], pa.list_(type_)),
                 pa.array([sum(held, [])], pa.list_(pa.bool_())),
                 pa.array([np.concatenate(lengths).tolist()], pa.list_(pa.int32())),
                 pa.array([pack(vocab, True)], pa.binary()), pa.array([pack(local.astype(np.uint32))], pa.binary())], names)

        for batch in batches:
            type_ = batch.schema.field(0).type
            for part in H.slices(batch, 2):
                h, offsets = H.words(part.column(2).to_pylist())
                ids.append(part.column(0).to_pylist())
                held.append(part.column(1).to_pylist())
                hashes.append(np.insert(h, offsets[1:], END))
                lengths.append(np.diff(offsets) + 1)
                have += len(hashes[-1])
                if have >= batch_tokens:
                    yield flush()
                    number, have = number + 1, 0
                    ids, held, hashes, lengths = [], [], [], []
        if have:
            yield flush()

    return rows.mapInArrow(run, f"batch long, doc_ids array<{kind}>, held array<boolean>, lengths array<int>, "
                                "vocab binary, ids binary")


class Batch:
    """One batch's arrays."""

    def __init__(self, row: dict):
        self.number = row["batch"]
        self.doc_ids, self.vocab, self.ids = row["doc_ids"], unpack(row["vocab"]), unpack(row["ids"]).astype(np.int64)
        self.lengths = np.array(row["lengths"], np.int64)
        self.held = np.array(row["held"], bool)
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.first = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.training = ~self.held[self.doc]

    def word_order(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(order of the vocabulary by bucket, borders of the buckets in it)."""
        b = ((H.mix(self.vocab) >> H.U(20)) % H.U(buckets)).astype(np.int32)
        order = np.argsort(b, kind="stable")
        return order, np.searchsorted(b[order], np.arange(buckets + 1))

    def counts(self, rows: list[dict], buckets: int) -> np.ndarray:
        """Corpus counts of the vocabulary, from the word buckets' answers."""
        order, borders = self.word_order(buckets)
        out = np.zeros(len(self.vocab), np.int64)
        for r in rows:
            out[order[borders[r["bucket"]]:borders[r["bucket"] + 1]]] = unpack(r["a"])
        return out

    def pairs(self, count: np.ndarray, buckets: int, total: int):
        """Distinct pairs in the order in which they are sent.

        (history index, word index, token -> pair, order, borders, salted): the history index len(vocab) is the begin mark.
        """
        v = len(self.vocab)
        history = np.concatenate(([v], self.ids[:-1]))
        history[self.first] = v
        codes, inverse = np.unique(history * v + self.ids, return_inverse=True)
        h, w = codes // v, codes % v
        share = np.append(count, count[np.searchsorted(self.vocab, END)])
        salts = 1 + np.minimum(2 * buckets * share // max(1, total), 4 * buckets)
        salt = (H.mix(self.vocab[w]) >> H.U(33)) % salts[h].astype(H.U)
        names = np.append(self.vocab, BEGIN)
        bucket = ((H.mix(names[h] ^ H.mix(salt)) >> H.U(20)) % H.U(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        return h, w, inverse, order, np.searchsorted(bucket[order], np.arange(buckets + 1)), salts > 1, names, share


def _rows(table: pa.Table) -> list[dict]:
    return table.to_pylist()


def _answer(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [()] * 6
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], ["bucket", "batch", "kind", "a", "b", "c"])


def count_words(batches: DataFrame, buckets: int) -> DataFrame:
    """Answers of the word buckets: kind 0, a = corpus counts of the words that the batch sent; kind 1, a = figures."""
    def send(parts):
        for part in parts:
            for row in part.to_pylist():
                b = Batch(row)
                own = np.bincount(b.ids[b.training], minlength=len(b.vocab)).astype(np.uint32)
                order, borders = b.word_order(buckets)
                cut = [order[borders[k]:borders[k + 1]] for k in range(buckets)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(buckets), pa.int32()), pa.array([b.number] * buckets, pa.int64()),
                     pa.array([pack(b.vocab[c], True) for c in cut], pa.binary()),
                     pa.array([pack(own[c]) for c in cut], pa.binary())], ["bucket", "batch", "words", "counts"])

    def add(table: pa.Table) -> pa.Table:
        rows = _rows(table)
        words = [unpack(r["words"]) for r in rows]
        _, inverse = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(inverse, np.concatenate([unpack(r["counts"]) for r in rows])).astype(np.int64)
        at = np.cumsum([0, *map(len, words)])
        bucket = rows[0]["bucket"]
        out = [(bucket, r["batch"], 0, pack(total[inverse[at[k]:at[k + 1]]]), None, None) for k, r in enumerate(rows)]
        return _answer([*out, (bucket, -1, 1, pack(np.array(_counts_of_counts(total), np.int64)), None, None)])

    sent = batches.mapInArrow(send, "bucket int, batch long, words binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(add, ANSWER)


def _figures(answers: DataFrame) -> list[int]:
    """Sum of the buckets' figures (one short row per bucket)."""
    got = [unpack(r["a"]) for r in answers.where("kind = 1").select("a").collect()]
    return np.sum(got, axis=0).tolist() if got else [0] * (K + 3)


def count_pairs(batches: DataFrame, words: DataFrame, buckets: int, uni: Unigrams) -> DataFrame:
    """Answers of the pair buckets: kind 0, a = corpus counts of the pairs that the batch sent, b, c = sums of P and
    counts of counts of the held-out histories it sent; kind 1, a = figures; kind 2, a, b, c = spread histories."""
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        cols = []
        for row in _rows(left):
            b = Batch(row)
            count = b.counts(_rows(right), buckets)
            h, w, inverse, order, borders, salted, names, _ = b.pairs(count, buckets, uni.total)
            own = np.bincount(inverse, b.training, len(h)).astype(np.uint32)
            needed = np.zeros(len(names), bool)
            needed[h[inverse[~b.training]]] = True
            for k in range(buckets):
                c = order[borders[k]:borders[k + 1]]
                if len(c):
                    new = np.ones(len(c), bool)
                    new[1:] = h[c][1:] != h[c][:-1]
                    hs, at = h[c][new], np.flatnonzero(new)
                    ws, which = np.unique(w[c], return_inverse=True)  # a next word is sent once per bucket
                    cols.append((k, b.number, pack(names[hs], True), pack(np.diff(np.append(at, len(c))).astype(np.uint32)),
                                 _pack48(b.vocab[ws]), pack(which.astype(np.uint32)), pack(own[c]),
                                 pack(count[ws].astype(np.uint32)), pack((needed[hs] + 2 * salted[hs]).astype(np.uint8))))
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 7]
        return pa.table([pa.array(x, t) for x, t in zip(list(zip(*cols)) or [()] * 9, kinds)],
                        ["bucket", "batch", "h", "runs", "w", "which", "own", "cw", "flags"])

    def add(table: pa.Table) -> pa.Table:
        rows = _rows(table)
        hs, runs = [unpack(r["h"]) for r in rows], [unpack(r["runs"]) for r in rows]
        flags = np.concatenate([unpack(r["flags"]) for r in rows])
        h_all = np.concatenate(hs)
        names, h_index = np.unique(h_all, return_inverse=True)
        h = np.repeat(h_index, np.concatenate(runs))
        which = [unpack(r["which"]) for r in rows]
        w = np.concatenate([_unpack48(r["w"])[k] for r, k in zip(rows, which)])
        key = H.mix(names[h] + H.mix(w))
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        total = np.bincount(inverse, np.concatenate([unpack(r["own"]) for r in rows])).astype(np.int64)
        cw = np.concatenate([unpack(r["cw"])[k] for r, k in zip(rows, which)])[first].astype(np.int64)
        seen = total > 0
        of, r = h[first][seen], total[seen]
        sums = np.bincount(of, uni.p(cw[seen]), len(names))
        hist = np.zeros((K + 2, len(names)), np.int64)  # types with count 1..K, then types and tokens above
        for k in range(1, K + 1):
            hist[k - 1] = np.bincount(of[r == k], minlength=len(names))
        hist[K] = np.bincount(of[r > K], minlength=len(names))
        hist[K + 1] = np.bincount(of[r > K], r[r > K], len(names)).astype(np.int64)
        out, p, q = [], 0, 0
        bucket = rows[0]["bucket"]
        for k, row in enumerate(rows):
            n, m = int(runs[k].sum()), len(hs[k])
            mine = h_index[q:q + m][flags[q:q + m] == 1]
            out.append((bucket, row["batch"], 0, pack(total[inverse[p:p + n]]), pack(sums[mine]), pack(hist[:, mine].reshape(-1))))
            p, q = p + n, q + m
        spread = np.unique(h_index[flags >= 2])
        out.append((bucket, -1, 1, pack(np.array(_counts_of_counts(total), np.int64)), None, None))
        out.append((bucket, -1, 2, pack(names[spread]), pack(sums[spread]), pack(hist[:, spread].reshape(-1))))
        return _answer(out)

    sent = batches.groupBy("batch").cogroup(words.where("kind = 0").groupBy("batch")).applyInArrow(
        send, "bucket int, batch long, h binary, runs binary, w binary, which binary, own binary, cw binary, flags binary")
    return sent.groupBy("bucket").applyInArrow(add, ANSWER)


def _pack48(x: np.ndarray) -> bytes:
    """The low 48 bits of hashes, uncompressed: they are random."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(H.U)


def _kept(hist: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discounted count of the seen words per history, from its counts of counts (K + 2 rows)."""
    kept = sum(d[k] * k * hist[k - 1] for k in range(1, K + 1))
    return kept + hist[K + 1] - 0.5 * hist[K]


def katz_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10,
                batch_tokens: int = TOKENS) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    stream = C.written(streams(docs, id_col, text_col, folds, batch_tokens), "streams")
    tokens = stream.select(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(MIN_BUCKETS, -(-tokens // BUCKET_TOKENS))
    words = C.written(count_words(stream, buckets), "unigrams")
    total, types, *n = _figures(words)
    uni = Unigrams(total, types, [0, *n])
    pairs = C.written(count_pairs(stream, words, buckets, uni), "bigrams")
    d = discounts([0, *_figures(pairs)[2:]])
    spread: dict[int, list] = {}  # at most two histories per bucket, each in a bounded number of parts
    for r in pairs.where("kind = 2").select("a", "b", "c").collect():
        names, sums, hist = unpack(r["a"]), unpack(r["b"]), unpack(r["c"])
        for name, s, x in zip(names.tolist(), sums.tolist(), hist.reshape(K + 2, -1).T):
            have = spread.setdefault(name, [0.0, np.zeros(K + 2, np.int64)])
            have[0] += s
            have[1] = have[1] + x
    kind = dict(stream.dtypes)["doc_ids"][6:-1]
    schema = (f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        answers = _rows(right)
        for row in _rows(left):
            b = Batch(row)
            count = b.counts([r for r in answers if r["round"] == 1], buckets)
            h, w, inverse, order, borders, salted, names, share = b.pairs(count, buckets, total)
            seen = np.zeros(len(h), np.int64)
            needed = np.zeros(len(names), bool)
            needed[h[inverse[~b.training]]] = True
            weight = np.ones(len(names))
            for i in np.flatnonzero(needed & salted):
                s, x = spread[int(names[i])]
                weight[i] = (1 - _kept(x, d) / share[i]) / (1 - s) if share[i] else 1.0
            for r in (r for r in answers if r["round"] == 2):
                c = order[borders[r["bucket"]]:borders[r["bucket"] + 1]]
                seen[c] = unpack(r["a"])
                hs = h[c][np.append(True, h[c][1:] != h[c][:-1])]
                hs = hs[needed[hs] & ~salted[hs]]
                s, x = unpack(r["b"]), unpack(r["c"]).reshape(K + 2, -1)
                of = share[hs]
                weight[hs] = np.where(of > 0, (1 - _kept(x, d) / np.maximum(of, 1)) / (1 - s), 1.0)
            lower = np.log10(uni.p(count))
            with np.errstate(divide="ignore"):
                pair = np.where(seen > 0, np.log10(np.maximum(discounted(seen, d), 1e-300)) - np.log10(np.maximum(share[h], 1)),
                                np.log10(weight[h]) + lower[w])
            base = np.log10((count + 0.1) / (total + 0.1 * (types + 1)))
            docs_ = len(b.lengths)
            out.append(pa.table([
                pa.array(b.doc_ids, left.schema.field("doc_ids").type.value_type), pa.array(b.held),
                pa.array(b.lengths), pa.array(np.bincount(b.doc, count[b.ids] > 0, docs_).astype(np.int64)),
                pa.array([total] * docs_, pa.int64()), pa.array(np.bincount(b.doc, base[b.ids], docs_)),
                pa.array(np.bincount(b.doc, pair[inverse], docs_))],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(out) if out else pa.schema([]).empty_table()

    both = words.where("kind = 0").withColumn("round", F.lit(1)).unionByName(
        pairs.where("kind = 0").withColumn("round", F.lit(2)))
    return stream.groupBy("batch").cogroup(both.groupBy("batch")).applyInArrow(score, schema)
