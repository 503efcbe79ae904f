"""Substring dedup by paragraph MinHash banding (operator 9).

*Paragraphs* are cut by content, not by position: every window of ``WINDOW`` successive 5-word shingles marks its
smallest hash (winnowing), and a paragraph runs from one mark to the next.  Equal passages are so cut alike wherever
they stand, also inside lines.  The first and the last ``WINDOW`` shingles of a passage hold a mark of it each, so a
passage of n words shows equal paragraphs of at least n + 1 - 2 * ``WINDOW`` words: 8 of 51 words.

*Banding.*  The number of bands and rows per band is the one of least cost (most rows per band, then fewest bands)
that reaches the wanted recall at the similarity threshold: five bands of two.  The (key, name) rows of the bands are
made distinct within a part of the texts, meet in one shuffle and are read in order of the key: every other paragraph
of a key is compared with the smallest one (a star).  Candidates are verified by exact Jaccard similarity of their
shingle sets, and verified links form components.  A paragraph's set is built once, from one of its documents.

*Rest.*  A key is few shingles, so a frequent sentence puts many unlike paragraphs under one key, and the smallest one
says nothing about the others.  The members of keys that hold several components are therefore compared once more: two
similar sets share one of their rarest shingles (as many as a set may miss, plus one), so the members are grouped by
these, where boilerplate comes last and shingles that occur once are dropped.  Groups of several components are
compared block against block, filtered by the Hamming distance of parity sketches of ``BITS`` bits and verified; of the
links only those that join two components are emitted.  So every similar pair of a key ends in one component.  The work
is quadratic in the size of a group of unlike paragraphs with a rare shingle in common, the output is not.

*Removals.*  A component that occurs in two documents or more is repeated; it stays in the document with the smallest
doc_id and is removed elsewhere.  Successive repeated paragraphs of a document form a run.  The first and the last
paragraph of a passage also hold foreign words, and similar paragraphs may add some to a run, at most ``WINDOW`` + 4 at
an end.  A run that is long enough without them is a repeated passage; any other is judged by its true length: the
passage reaches from the first to the last stretch of ``min_run`` words that holds a paragraph of the run and occurs,
word for word, in another document as well.  Paragraphs outside are left alone.  (Below 49 words, where a passage need
not show a paragraph, the length of the run decides.)

Cases: null and empty texts have no paragraphs; a text under five words is one paragraph; passages repeated within one
document only are not reported; rows that share a doc_id are separate documents under one name; null ids are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common as C
from . import wordhash as H
from .components import components
from .ngram_join import _relinked, _with_component

WINDOW = 22     # at most 23: a passage of 51 words, 47 shingles, then shows two marks
MIN_RUN = 51    # words of a passage
RECALL = 0.98
MAX_HASHES = 16
KEY_ROWS = 1_000_000    # band keys (16 bytes each) that are broadcast after being counted; more are joined
BITS = 512      # bits of the parity sketch that filters pairs
BLOCK = 512     # members of a group compared at a time, about


def tune(threshold: float = C.SIMILARITY, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows) that find a pair at the threshold with at least ``recall``, of at most ``max_hashes`` hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        for bands in range(1, max_hashes // rows + 1):
            if 1 - (1 - threshold ** rows) ** bands >= recall:
                best = (bands, rows)
                break
    if best is None:
        raise ValueError("more hashes are needed")
    return best


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over x[i : i + width] for every i (shorter at the end), by doubling."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[:len(out) - step] = op(out[:len(out) - step], out[step:])
        have += step
    return out


def marks(values: np.ndarray, texts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Is the shingle the least of some whole window of its text?  Of a run of equal shingles only the first is."""
    n = len(values)
    if n < window:
        return np.zeros(n, bool)
    low = _slide(values, window, np.minimum)
    whole = np.zeros(n, bool)
    whole[:n - window + 1] = texts[:n - window + 1] == texts[window - 1:]
    low = np.where(whole, low, H.U(0))
    # The largest of the minima of the windows that hold position i, the windows starting at i - window + 1 .. i.
    high = _slide(np.concatenate((np.zeros(window - 1, H.U), low)), window, np.maximum)[:n]
    out = (high == values) & (high > 0)
    out[1:] &= (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])
    return out


def paragraphs(texts: list[str | None], window: int = WINDOW):
    """(shingles, text number of each, first shingle of every paragraph, its text, its first word within the text,
    its words)."""
    hashes, offsets = H.words(texts)
    values, own = H.shingles(hashes, offsets, C.SHINGLE_WORDS)
    n = len(values)
    if not n:
        none = np.zeros(0, np.int64)
        return values, own, none, none, none, none
    new = np.ones(n, bool)
    new[1:] = own[1:] != own[:-1]
    first = np.flatnonzero(new | marks(values, own, window))
    text = own[first]
    start_of = np.full(len(texts), 0, np.int64)
    start_of[own[new]] = np.flatnonzero(new)
    ends = np.concatenate((first[1:], [n]))
    counts = np.diff(offsets)
    # A paragraph's words reach to its last shingle's end.
    length = np.where(counts[text] < C.SHINGLE_WORDS, counts[text], ends - first + C.SHINGLE_WORDS - 1)
    return values, own, first, text, first - start_of[text], length


def _named(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64-bit name of every paragraph: equal for equal multisets of shingles."""
    return H.mix(np.add.reduceat(H.mix(values + H.U(7)), first)) if len(first) else np.zeros(0, H.U)


def _banded(values: np.ndarray, first: np.ndarray, bands: int, rows: int) -> list[np.ndarray]:
    """Band keys of every paragraph.  The shingle hashes are mixed already: times an odd number they are another order."""
    out = []
    for b in range(bands):
        key = np.full(len(first), b + 1, H.U)
        for r in range(rows):
            salt = H.mix(np.full(1, b * rows + r + 1, H.U))[0] | H.U(1)
            key = H.mix(key * H.U(31) + np.minimum.reduceat(values * salt, first)) if len(first) else key
        out.append(key)
    return out


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and g, a hash of the text: what a row is found again by."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(C.text_of(text_col)).alias("g"))


def paragraph_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: rid, doc_id, g and arrays over its paragraphs: at (first word), words, name."""
    frame = _texts(docs, id_col, text_col).select("doc_id", "g", "text")
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in H.slices(batch, 2):
                values, _, first, text, at, words = paragraphs(part.column(2).to_pylist())
                per = pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)), pa.int32())
                cols = [pa.ListArray.from_arrays(per, pa.array(x, t)) for x, t in (
                    (at, pa.int32()), (words, pa.int32()), (H.signed(_named(values, first)), pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *cols],
                                                 ["doc_id", "g", "at", "words", "name"])

    return frame.mapInArrow(run, f"doc_id {kind}, g long, at array<int>, words array<int>, name array<long>").withColumn(
        "rid", F.monotonically_increasing_id())


def _starred(docs: DataFrame, text_col: str, bands: int, rows: int) -> DataFrame:
    """(key, a, name): the paragraphs under a band key other than its smallest one, ``a``."""
    def run(batches):
        for batch in batches:
            for part in H.slices(batch, 0):
                values, _, first, *_ = paragraphs(part.column(0).to_pylist())
                name, once = np.unique(H.signed(_named(values, first)), return_index=True)
                for keys in _banded(values, first, bands, rows):  # a paragraph counts once in a part
                    yield pa.RecordBatch.from_arrays([pa.array(H.signed(keys[once]), pa.int64()), pa.array(name, pa.int64())],
                                                     ["key", "name"])

    def stars(batches):  # in order of key and name; only the key at hand is remembered
        last_key = star = last = None
        for batch in batches:
            key, name = batch.column("key").to_numpy(), batch.column("name").to_numpy()
            if not len(key):
                continue
            same = np.concatenate(([last_key is not None and key[0] == last_key], key[1:] == key[:-1]))
            before = np.concatenate(([name[0] if last is None else last], name[:-1]))
            group = np.cumsum(~same)
            first = np.concatenate(([name[0] if star is None else star], name[~same]))[group]
            out = same & (name != before)
            yield pa.RecordBatch.from_arrays([pa.array(x[out], pa.int64()) for x in (key, first, name)], ["key", "a", "name"])
            last_key, star, last = key[-1], first[-1], name[-1]

    keyed = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "key long, name long")
    return keyed.repartition("key").sortWithinPartitions("key", "name").mapInArrow(stars, "key long, a long, name long")


def _found_again(docs: DataFrame, lists: DataFrame, entries: int, id_col: str, text_col: str) -> DataFrame:
    """The documents of the written ``lists`` (_id, _g, arrays of ``entries`` entries in all), numbered, with their lists."""
    side = F.broadcast(lists) if entries <= KEY_ROWS else lists
    return _texts(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()).join(
        side, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("g") == F.col("_g")))


def _members(docs: DataFrame, paras: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(name, sorted distinct shingles as bytes) of the ``wanted`` paragraphs (name, lo: the row it is read from)."""
    lists = wanted.groupBy("lo").agg(F.collect_list("name").alias("names"))  # paragraphs of one document
    lists = C.written(lists.join(paras.select(F.col("rid").alias("lo"), F.col("doc_id").alias("_id"), F.col("g").alias("_g")),
                                 "lo").drop("lo"), "para-docs")
    rows = _found_again(docs, lists, wanted.count(), id_col, text_col)

    def run(batches):
        for batch in batches:
            for part in H.slices(batch, 0):
                values, _, first, *_ = paragraphs(part.column(0).to_pylist())
                ends = np.concatenate((first[1:], [len(values)]))
                name = H.signed(_named(values, first))
                name, once = np.unique(name, return_index=True)
                here = np.flatnonzero(np.isin(name, part.column(1).flatten().to_numpy()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[here], pa.int64()),
                     pa.array([np.unique(values[first[k]:ends[k]]).tobytes() for k in once[here]], pa.binary())],
                    ["name", "members"])

    return C.written(rows.select("text", "names").mapInArrow(run, "name long, members binary").dropDuplicates(["name"]),
                     "para-members")


def _stretches(docs: DataFrame, runs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """Where ``size`` words with a paragraph of a run occur in another row as well: _id, _g, _first (word of the run) and
    the first words ``lo`` and ``hi`` of the first and the last such stretch.  ``runs`` (written): doc_id, g, run_first,
    first_end (end of the first paragraph), last_at (first word of the last one), judged (else only compared with)."""
    kind = runs.schema["doc_id"].dataType.simpleString()
    parts = ("run_first", "first_end", "last_at", "judged")
    lists = C.written(runs.groupBy(F.col("doc_id").alias("_id"), F.col("g").alias("_g")).agg(
        F.collect_list(F.struct(*parts)).alias("r")).select("_id", "_g", *[F.col(f"r.{c}").alias(c) for c in parts]),
        "para-runs")  # runs of one document
    rows = _found_again(docs, lists, runs.count(), id_col, text_col).select(
        "text", "_id", "_g", "row", *parts)

    def run(batches):
        for batch in batches:
            for part in H.slices(batch, 0):
                hashes, offsets = H.words(part.column(0).to_pylist())
                of = np.repeat(np.arange(part.num_rows), part.column(4).value_lengths().to_numpy())
                at, end, last = (part.column(k).flatten().to_numpy().astype(np.int64) for k in (4, 5, 6))
                start = offsets[of]
                # The stretches that hold a whole paragraph of the run begin at lo .. hi.
                lo, hi = np.maximum(start, start + end - size), np.minimum(start + last, offsets[of + 1] - size)
                n = np.maximum(0, hi - lo + 1)
                which = np.repeat(np.arange(len(n)), n)
                place = lo[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                judged = part.column(7).flatten().to_numpy(zero_copy_only=False)[which]
                once = np.flatnonzero(~judged)
                once = once[np.unique(place[once], return_index=True)[1]]  # stretches compared with, once each
                keep = np.concatenate((np.flatnonzero(judged), once))
                which, place, judged = which[keep], place[keep], judged[keep]
                h = H.signed(H.stretches(hashes, place, size))
                cols = [part.column(k).take(pa.array(of[which])) for k in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), *cols, pa.array(at[which], pa.int32()),
                     pa.array(place - start[which], pa.int32()), pa.array(judged)],
                    ["h", "_id", "_g", "row", "_first", "place", "judged"])

    every = C.written(rows.mapInArrow(run, f"h long, _id {kind}, _g long, row long, _first int, place int, judged boolean"),
                      "para-stretches")
    twice = C.written(every.groupBy("h").agg(F.min("row").alias("lo"), F.max("row").alias("hi")).where("lo <> hi")
                      .select("h"), "para-common")
    return C.written(every.where("judged").join(C.small(twice, KEY_ROWS), "h").groupBy("_id", "_g", "_first").agg(
        F.min("place").alias("lo"), F.max("place").alias("hi")), "para-true")


def _similar(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, H.U), np.frombuffer(y, H.U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(members.select(F.col("name").alias("b"), F.col("members").alias("y")), "b")
    return one.join(members.select(F.col("name").alias("a"), F.col("members").alias("x")), "a").mapInArrow(
        run, "a long, b long")


def _rarest(members: DataFrame, percent: int) -> DataFrame:
    """(key, name): the rarest shingles of every set, one more than it may miss, of those that occur more than once."""
    def run(batches):
        for batch in batches:
            names, sets = batch.column("name").to_numpy(), [np.frombuffer(x, np.int64) for x in batch.column("members").to_pylist()]
            sizes = np.array([len(x) for x in sets], np.int64)
            spare = sizes + (-percent * sizes) // 100 + 1  # percent of the set are shared at least
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(names, sizes), pa.int64()), pa.array(np.repeat(sizes, sizes), pa.int32()),
                 pa.array(np.repeat(spare, sizes), pa.int32()),
                 pa.array(np.concatenate(sets) if sets else [], pa.int64())], ["name", "all", "spare", "key"])

    own = C.written(members.mapInArrow(run, "name long, all int, spare int, key long"), "para-shingles")
    often = C.written(own.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "para-often")
    own = own.join(C.small(often, KEY_ROWS), "key")
    w = W.partitionBy("name")  # the shingles of one paragraph
    own = own.withColumn("place", F.row_number().over(w.orderBy("n", "key"))).withColumn("seen", F.count("*").over(w))
    # Shingles that occur once come first in the order; there are all - seen of them.
    return own.where(F.col("place") + F.col("all") - F.col("seen") <= F.col("spare")).select("key", "name")


def _joining(x: list[dict], y: list[dict] | None, percent: int) -> tuple[list[int], list[int]]:
    """Links between members of the blocks ``x`` and ``y`` (None: within ``x``) that join two components; links that
    follow from those before are left out."""
    rows = x if y is None else x + y
    start = 0 if y is None else len(x)
    sets = [np.frombuffer(m["members"], H.U) for m in rows]
    sizes = np.array([len(s) for s in sets], np.int64)
    h = H.mix(np.concatenate(sets) + H.U(0xB175))
    sketch = np.zeros((len(rows), BITS // 64), H.U)
    at = (np.repeat(np.arange(len(rows)), sizes), ((h >> H.U(6)) % H.U(BITS // 64)).astype(np.int64))
    np.bitwise_xor.at(sketch, at, H.U(1) << (h & H.U(63)))
    label = np.unique([m["component"] for m in rows], return_inverse=True)[1]
    a, b = [], []
    for i in range(len(x)):
        first = max(start, i + 1)
        apart = np.flatnonzero(label[first:] != label[i]) + first
        if not len(apart):
            continue
        far = np.bitwise_count(sketch[apart] ^ sketch[i]).sum(1, dtype=np.int64)
        for j in apart[(100 + percent) * far <= (100 - percent) * (sizes[apart] + sizes[i])].tolist():
            if label[j] == label[i]:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                a.append(rows[i]["name"])
                b.append(rows[j]["name"])
                label[label == label[j]] = label[i]
    return a, b


def _rest(shared: DataFrame, comp: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join components, among the members (key, name) of keys that hold several components."""
    own = _with_component(shared.select("key", "name"), "name", comp)
    mixed = C.written(own.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                      .where("lo <> hi").select("key"), "para-mixed")
    names = C.written(shared.join(C.small(mixed, KEY_ROWS), "key").select("name").distinct(), "para-open")
    sets = C.written(_with_component(members.join(C.small(names, KEY_ROWS), "name", "left_semi"), "name", comp), "para-sets")
    near = C.written(_rarest(sets.select("name", "members"), percent), "para-rarest")

    groups = C.written(near.join(sets.select("name", "component"), "name").groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size")).where("lo <> hi")
        .select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts")), "para-groups")
    grouped = near.join(C.small(groups, KEY_ROWS), "key").join(sets, "name")
    blocks = C.written(grouped.groupBy("key", "parts", F.pmod(F.xxhash64("name"), F.col("parts")).cast("int").alias("part")).agg(
        F.collect_list(F.struct("name", "component", "members")).alias("m")), "para-blocks")  # about BLOCK members each

    def within(batches):
        for batch in batches:
            for m in batch.column("m"):
                a, b = _joining(m.as_py(), None, percent)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def between(table):
        a, b = [], []
        for row in table.select(["x", "y"]).to_pylist():
            for out, got in zip((a, b), _joining(row["x"], row["y"], percent)):
                out += got
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    one = blocks.select("m").mapInArrow(within, "a long, b long")
    large = blocks.where("parts > 1")
    left, right = (large.select("key", F.col("part").alias(f"p{k}"), F.col("m").alias(v)) for k, v in ((0, "x"), (1, "y")))
    # Pairs of blocks go to Python one by one.
    two = left.join(right, "key").where("p0 < p1").groupBy("key", "p0", "p1").applyInArrow(between, "a long, b long")
    return one.unionByName(two)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      threshold: float = C.SIMILARITY, recall: float = RECALL, min_run: int = MIN_RUN) -> DataFrame:
    """One row per repeated paragraph: doc_id, first_word, n_words, component, keep_id, kept, run_first, run_words."""
    bands, rows = tune(threshold, recall)
    paras = C.written(paragraph_table(docs, id_col, text_col), "paragraphs")
    stars = C.written(_starred(docs, text_col, bands, rows), "para-stars")
    pairs = C.written(stars.select("a", F.col("name").alias("b")).distinct(), "para-pairs")

    flat = paras.select("rid", "doc_id", "g", F.posexplode(F.arrays_zip("at", "words", "name")).alias("pos", "p")).select(
        "rid", "doc_id", "g", "pos", "p.at", "p.words", "p.name")
    wanted = C.written(pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct(), "para-wanted")
    # The first and the last row that hold a paragraph.
    seen = C.written(flat.groupBy("name").agg(F.min("rid").alias("lo"), F.max("rid").alias("hi")).join(
        C.small(wanted.withColumn("wanted", F.lit(True)), KEY_ROWS), "name", "left").where("wanted OR lo <> hi"), "para-seen")
    comp = None
    if not pairs.isEmpty():
        members = _members(docs, paras, seen.where("wanted").select("name", "lo"), id_col, text_col)
        comp = C.written(components(C.written(_similar(pairs, members, round(100 * threshold)), "para-links")),
                         "para-components")
        shared = stars.select("key", "name").unionByName(stars.select("key", F.col("a").alias("name")).distinct())
        rest = C.written(_rest(shared, comp, members, round(100 * threshold)), "para-rest")
        if not rest.isEmpty():
            comp = _relinked(comp, rest)
        comp = comp.select(F.col("node").alias("name"), "component")
    owned = seen.withColumn("component", F.col("name")) if comp is None else seen.join(
        C.small(comp, KEY_ROWS), "name", "left").withColumn("component", F.coalesce("component", "name"))
    owned = C.written(owned.select("name", "component", "lo", "hi"), "para-owned")
    spread = C.written(owned.groupBy("component").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi")
                       .select("component"), "para-spread")
    hot = C.written(owned.select("name", "component").join(spread, "component"), "para-repeated")

    found = flat.join(C.small(hot, KEY_ROWS), "name").drop("name")
    w = W.partitionBy("rid").orderBy("pos")  # the paragraphs of one document
    new = (F.col("pos") - F.lag("pos", 1, -9).over(w) > 1).cast("int")
    found = found.withColumn("new", new).withColumn("run", F.sum("new").over(w)).drop("new")
    run = W.partitionBy("rid", "run")
    found = found.withColumn("run_first", F.min("at").over(run)).withColumn(
        "run_words", F.max(F.col("at") + F.col("words")).over(run) - F.col("run_first")).withColumn(
        "first_end", F.min(F.col("at") + F.col("words")).over(run)).withColumn("last_at", F.max("at").over(run))
    # A passage of min_run words shows a run of ``low`` words at least; a run of ``sure`` words is one.
    low, sure = min_run, min_run
    if min_run > 2 * WINDOW + 4:
        low, sure = min_run + 1 - 2 * WINDOW, min_run + 2 * (WINDOW + 4)
    found = C.written(found.where(F.col("run_words") >= low), "para-found")
    out = found.where(F.col("run_words") >= sure)
    open_ = found.where(F.col("run_words") < sure)
    if not open_.isEmpty():
        # The sure runs' paragraphs that the open ones are to be compared with, from one of several equal texts.
        also = out.join(C.small(C.written(open_.select("component").distinct(), "para-asked"), KEY_ROWS), "component").groupBy(
            "g", "at").agg(F.min("doc_id").alias("doc_id"), F.first("words").alias("words")).select(
            "doc_id", "g", F.col("at").alias("run_first"), (F.col("at") + F.col("words")).alias("first_end"),
            F.col("at").alias("last_at"), F.lit(False).alias("judged"))
        runs = C.written(open_.select("doc_id", "g", "run_first", "first_end", "last_at", F.lit(True).alias("judged"))
                         .distinct().unionByName(also), "para-open-runs")
        true = C.small(_stretches(docs, runs, min_run, id_col, text_col))
        longer = open_.join(
            true, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("g") == F.col("_g")) & (F.col("run_first") == F.col("_first"))
        ).where((F.col("at") >= F.col("lo")) & (F.col("at") + F.col("words") <= F.col("hi") + min_run))
        out = out.unionByName(longer.withColumn("run_first", F.col("lo")).withColumn(
            "run_words", F.col("hi") + min_run - F.col("lo")).select(*out.columns))
    out = C.written(out, "para-passages")
    keep = C.written(out.groupBy("component").agg(F.min("rid").alias("lo"), F.max("rid").alias("hi"),
                                                  F.min("doc_id").alias("keep_id")).where("lo <> hi").select(
        "component", "keep_id"), "para-keep")
    return out.join(C.small(keep, KEY_ROWS), "component").select(
        "doc_id", F.col("at").alias("first_word"), F.col("words").alias("n_words"), "component", "keep_id",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "run_first", "run_words")
