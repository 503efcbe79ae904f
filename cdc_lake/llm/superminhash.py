"""Near-duplicate documents by SuperMinHash signatures (operator 12).

*Signature.*  A shingle's hash seeds a permutation p of the ``SIZE`` components, drawn step by step, and a fraction r per
step: in step j the shingle offers j + r to component p(j), and a component keeps its smallest offer.  The ranks of one
shingle are correlated (a permutation, not independent draws), which is what lowers the variance of the estimate for
sets that are small against the signature.  From step j on nothing below j is offered, so a document stops as soon as
all its components are below j: two or three steps for usual texts.  The steps of all documents of a part run together
in numpy, shingles in blocks of bounded size.

*Banding.*  ``BANDS`` bands of ``ROWS`` components: a pair at Jaccard 0.8 shares no band with probability
(1 - 0.8^4)^32 = 5e-8, more similar pairs with less.

*Verification and union-find grouping.*  Equal sets are collapsed first (by 128 bits).  In a band every member is paired
with the smallest member, a star and not a clique; pairs are confirmed on the full sets of shingle hashes and grouped to
components by union-find steps on tables (:mod:`.components`).  Members of one band that are still in different
components are then paired block by block: pairs of blocks of at most about ``BLOCK`` members go through numpy, which
returns the pairs whose sizes allow 0.8, whose signatures agree nearly often enough, and whose parity sketches (``BITS``
bits of the whole set, each the parity of its shingles) differ in no more bits than the difference of a link can turn;
both tests lie ``DEVIATIONS`` standard deviations off a pair at 0.8 (it fails one with probability 1e-8).  What passes is
nearly only links.  A first round takes of it no more pairs than join the block's components, and confirms them; the
second takes and confirms every pair between components that are still apart.  No link between different sets is lost to a star, copies
and near copies cost rows in proportion to their number, and no bucket is gathered in one task.

Long texts are hashed in slices of bounded length; what grows with a single text is its set of distinct shingles.

Cases: null texts and texts without words have empty sets and link with nothing; a text of one word has it as its one
shingle; rows with equal doc_id are documents of their own; a null doc_id names a component only if all its members
have none (and is then kept, as its own name).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import wordhash as H
from .components import components

WORDS = 2
PERCENT = 80
BANDS, ROWS = 32, 4
SIZE = BANDS * ROWS
STEP_BITS = 48           # an offer is step << STEP_BITS | fraction
SHINGLES = 1 << 16       # shingles whose permutations are held at a time
LONG = 1 << 20           # characters of a text beyond which it is hashed in slices
BLOCK = 1024
BITS = 2048              # bits of the parity sketch that filters pairs
DEVIATIONS = 5.7
#: Components that the signatures of a pair at 0.8 have in common, at least.
AGREE = int(SIZE * PERCENT / 100 - DEVIATIONS * (SIZE * PERCENT / 100 * (1 - PERCENT / 100)) ** 0.5)
SPACE = re.compile("[\\x20\\x09-\\x0D]")


# ------------------------------------------------------------------ sets
def long_set(text: str, width: int, chars: int = LONG) -> np.ndarray:
    """Sorted distinct shingle hashes of one long text, read in slices cut at white space."""
    tail, found, start = np.zeros(0, H.U), [], 0
    held = 0
    total = 0
    while start < len(text):
        end = start + chars
        if end < len(text):
            cut = SPACE.search(text, end)
            end = cut.start() if cut else len(text)
        words, _ = H.words([text[start:end]])
        total += len(words)
        words = np.concatenate((tail, words))
        if len(words) >= width:
            values, _ = H.shingles(words, np.array([0, len(words)]), width)
            found.append(np.unique(values))
            held += len(found[-1])
            if len(found) > 1 and held > 4 * len(found[0]):
                found = [np.unique(np.concatenate(found))]
                held = len(found[0])
        tail = words[max(0, len(words) - width + 1):]
        start = end
    if total < width:
        return np.unique(H.shingles(tail, np.array([0, len(tail)]), width)[0])
    return np.unique(np.concatenate(found))


def sets(texts: list[str | None], width: int = WORDS, long: int = LONG) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, and the offsets of the texts' sets."""
    big = [i for i, t in enumerate(texts) if t is not None and len(t) > long]
    short = [None if t is not None and len(t) > long else t for t in texts]
    values, own = H.shingles(*H.words(short), width)
    values, offsets = H.unique_sets(values, own, len(texts))
    if big:
        parts = [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        for i in big:
            parts[i] = long_set(texts[i], width, long)
        values = np.concatenate(parts)
        offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    return values, offsets


# ------------------------------------------------------------------ signatures
def _offers(values: np.ndarray, own: np.ndarray, sig: np.ndarray) -> None:
    """Lower the signatures ``sig`` (document, component) by the offers of these shingles (``own``: their documents)."""
    perm = np.broadcast_to(np.arange(SIZE, dtype=np.uint8), (len(values), SIZE)).copy()
    for j in range(SIZE):
        h = H.mix(values + H.U((2 * j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        k = j + ((h & H.U(0xFFFF)) * H.U(SIZE - j) >> H.U(16)).astype(np.int64)  # the next of the permutation
        rows = np.arange(len(values))
        pick = perm[rows, k]
        perm[rows, k] = perm[:, j]
        offer = (H.U(j) << H.U(STEP_BITS)) | (h >> H.U(64 - STEP_BITS))
        np.minimum.at(sig, (own, pick), offer)
        # Later steps offer (j + 1) << STEP_BITS at least: documents whose components are all below are done.
        docs = np.unique(own)
        open_ = docs[sig[docs].max(axis=1) >= H.U(j + 1) << H.U(STEP_BITS)]
        if not len(open_):
            return
        if len(open_) < len(docs):
            live = np.isin(own, open_)
            values, own, perm = values[live], own[live], perm[live]


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(document, component) signatures; those of empty sets are all ones."""
    n = len(offsets) - 1
    sig = np.full((n, SIZE), ~H.U(0), H.U)
    own = np.repeat(np.arange(n), np.diff(offsets))
    for a in range(0, len(values), SHINGLES):
        _offers(values[a:a + SHINGLES], own[a:a + SHINGLES], sig)
    return sig


def parity(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(document, 64-bit word) parity sketches of the whole sets: every shingle turns one of ``BITS`` bits."""
    out = np.zeros((len(offsets) - 1, BITS // 64), H.U)
    h = H.mix(values + H.U(0x0DD))
    word = ((h >> H.U(6)) % H.U(BITS // 64)).astype(np.int64)
    np.bitwise_xor.at(out, (np.repeat(np.arange(len(out)), np.diff(offsets)), word), H.U(1) << (h & H.U(63)))
    return out


def most_bits(size: np.ndarray) -> np.ndarray:
    """Bits in which the parity sketches of a link with ``size`` shingles in both sets together differ at most: its
    difference, or where shingles fall on the same bits, the mean for that difference and ``DEVIATIONS`` beyond."""
    apart = (100 - PERCENT) / (100 + PERCENT) * size
    p = (1 - np.exp(-2 * apart / BITS)) / 2
    return np.minimum(np.floor(apart), BITS * p + DEVIATIONS * np.sqrt(BITS * p * (1 - p)) + 1)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(document, band) hashes of the bands' components."""
    out = np.zeros((len(sig), BANDS), H.U)
    for r in range(ROWS):
        out = H.mix(out + sig[:, r::ROWS] + H.U(r + 1))
    return H.mix(out + np.arange(BANDS, dtype=H.U)[None, :] * H.U(0x9E3779B97F4A7C15))


def hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: rid, doc_id, set size, 128-bit set hash, band keys, 16 bits of every component, parity
    sketch."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in H.slices(batch, 1):
                values, offsets = sets(part.column(1).to_pylist())
                sig = signatures(values, offsets)
                keys = H.signed(np.ascontiguousarray(band_keys(sig)))
                some = H.mix(sig).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(offsets), pa.int64()),
                     *(pa.array(H.signed(H.fold(values, offsets, seed))) for seed in (1, 2)),
                     pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1)), BANDS).cast(pa.list_(pa.int64())),
                     pa.array([s.tobytes() for s in some], pa.binary()),
                     pa.array([s.tobytes() for s in parity(values, offsets)], pa.binary())],
                    ["doc_id", "n", "s1", "s2", "bands", "sig", "parity"])

    return rows.mapInArrow(run, f"doc_id {kind}, n long, s1 long, s2 long, bands array<long>, sig binary, "
                           "parity binary").withColumn(
        "rid", F.monotonically_increasing_id())


# ------------------------------------------------------------------ verification
def _member_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rid, set as bytes) of the wanted representatives (rid, doc_id, s1, s2), hashed again from their texts."""
    ids = C.small(C.written(wanted.select(F.col("doc_id").alias("_id")).distinct(), "wanted-ids"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
        ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def run(batches):
        for batch in batches:
            for part in H.slices(batch, 0):
                values, offsets = sets(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(H.signed(H.fold(values, offsets, seed))) for seed in (1, 2)),
                     pa.array([values[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], pa.large_binary()).cast(pa.binary())],
                    ["s1", "s2", "members"])

    made = rows.select("text").mapInArrow(run, "s1 long, s2 long, members binary")
    # Copies of a representative under its own doc_id make the same set: one of them counts.
    return C.written(made.join(C.small(wanted).select("rid", "s1", "s2"), ["s1", "s2"]).select("rid", "members")
                     .dropDuplicates(["rid"]), "sets")


def _confirm_rows(batches):
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            x, y = np.frombuffer(x, H.U), np.frombuffer(y, H.U)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def confirmed(pairs: DataFrame, sets_: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= 80 * union."""
    one = pairs.join(sets_.select(F.col("rid").alias("b"), F.col("members").alias("y")), "b")
    both = one.join(sets_.select(F.col("rid").alias("a"), F.col("members").alias("x")), "a")
    return both.mapInArrow(_confirm_rows, "a long, b long")


def with_component(rows: DataFrame, node: str, comp: DataFrame) -> DataFrame:
    """``rows`` with the component of column ``node`` (itself if it has no link)."""
    c = C.small(comp).select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    return rows.join(c, F.col(node) == F.col("_n"), "left").withColumn(
        "component", F.coalesce("_c", node)).drop("_n", "_c")


def _alike(rows_x, rows_y, same: bool, forest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs between two blocks of members (rid, component, n, sig, parity) that may be links and are not grouped yet;
    with ``forest`` only those that join groups which earlier pairs of the block have not joined."""
    rx, cx, nx = (rows_x.column(c).to_numpy(zero_copy_only=False) for c in ("rid", "component", "n"))
    ry, cy, ny = (rows_y.column(c).to_numpy(zero_copy_only=False) for c in ("rid", "component", "n"))
    sx, sy = (np.frombuffer(b"".join(r.column("sig").to_pylist()), np.uint16).reshape(-1, SIZE) for r in (rows_x, rows_y))
    px, py = (np.frombuffer(b"".join(r.column("parity").to_pylist()), H.U).reshape(-1, BITS // 64) for r in (rows_x, rows_y))
    a, b = [], []
    up: dict[int, int] = {}

    def group(c: int) -> int:
        while up.get(c, c) != c:
            c = up[c]
        return c

    for k in range(len(rx)):
        near = (cx[k] != cy) & (100 * np.minimum(nx[k], ny) >= PERCENT * np.maximum(nx[k], ny))
        if same:
            near &= ry > rx[k]
        at = np.flatnonzero(near)
        at = at[(sy[at] == sx[k]).sum(1) >= AGREE]
        at = at[np.bitwise_count(py[at] ^ px[k]).sum(1, dtype=np.int64) <= most_bits(nx[k] + ny[at])]
        if forest and len(at):
            new = []
            for c, first in zip(*(x.tolist() for x in np.unique(cy[at], return_index=True))):
                own, other = group(int(cx[k])), group(c)
                if own != other:
                    up[other] = own
                    new.append(at[first])
            at = np.array(new, np.int64)
        a.append(np.minimum(rx[k], ry[at]))
        b.append(np.maximum(rx[k], ry[at]))
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *a]), np.concatenate([empty, *b])


def _block_pairs(table: pa.Table, forest: bool) -> pa.Table:
    """Pairs from the members of one pair of blocks of a band key (``side`` 0 and 1; one side alone: within it)."""
    import pyarrow.compute as pc

    table = table.combine_chunks()
    x, y = (table.filter(pc.equal(table.column("side"), s)) for s in (0, 1))
    a, b = _alike(x, y, False, forest) if y.num_rows else _alike(x, x, True, forest)
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _small_keys(batches, forest: bool):
    """The same for small keys, many to a batch: all members of a key are in one row."""
    for batch in batches:
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for row in batch.column("m"):
            t = pa.Table.from_batches([pa.RecordBatch.from_struct_array(row.values)])
            x, y = _alike(t, t, True, forest)
            a.append(x)
            b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


def open_pairs(cells: DataFrame, comp: DataFrame, nodes: DataFrame, block: int, forest: bool) -> DataFrame:
    """Pairs (a, b) of members of one band key in different components, by signature; ``nodes``: rid, n, sig, parity.

    With ``forest`` a block returns fewer pairs than it has components, without it all pairs.
    """
    own = C.written(with_component(cells, "rid", comp), "band-members")
    per = own.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"))
    open_ = C.written(per.where("lo <> hi").select("key", F.ceil(F.col("size") / block).cast("int").alias("parts")), "open-keys")
    full = own.join(C.small(open_), "key").join(nodes.select("rid", "n", "sig", "parity"), "rid")
    full = C.written(full.select("key", "parts", "rid", "component", "n", "sig", "parity",
                                 F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int").alias("part")), "open-members")
    few = full.where("parts = 1").groupBy("key").agg(F.collect_list(F.struct("rid", "component", "n", "sig", "parity")).alias("m"))
    small = few.select("m").mapInArrow(lambda it: _small_keys(it, forest), "a long, b long")
    # A member goes to the pairs of blocks it belongs to: its own block with every block of the key.
    k = F.col("part")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    many = full.where("parts > 1").select("key", "rid", "component", "n", "sig", "parity", "part", other.alias("other")).select(
        "key", F.least(k, "other").alias("p"), F.greatest(k, "other").alias("q"),
        F.when(k <= F.col("other"), 0).otherwise(1).alias("side"), "rid", "component", "n", "sig", "parity")
    large = many.groupBy("key", "p", "q").applyInArrow(
        lambda t: _block_pairs(t.select(["side", "rid", "component", "n", "sig", "parity"]), forest), "a long, b long")
    return small.unionByName(large).distinct()


def _joined(comp: DataFrame, found: DataFrame) -> DataFrame:
    """``comp`` after the further links ``found`` (a, b): components of components."""
    ends = found.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
    known = C.written(with_component(ends, "rid", comp), "linked")
    of = {s: known.select(F.col("rid").alias(s), F.col("component").alias(f"c{s}")) for s in "ab"}
    e = found.join(of["a"], "a").join(of["b"], "b")
    top = C.written(components(e.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).select(
        F.col("node").alias("_n"), F.col("component").alias("_c")), "top")
    both = comp.unionByName(known.select(F.col("rid").alias("node"), "component")).distinct()
    return C.written(both.join(C.small(top), F.col("component") == F.col("_n"), "left").select(
        "node", F.coalesce("_c", "component").alias("component")), "components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept."""
    rows = C.written(hashed(docs, id_col, text_col), "signatures")
    filled = rows.where("n > 0")
    classes = C.written(filled.groupBy("n", "s1", "s2").agg(F.min("rid").alias("rep")), "classes")
    named = C.written(filled.select("rid", "doc_id", "n", "s1", "s2").join(classes, ["n", "s1", "s2"]), "named")
    reps = filled.join(named.where("rid <> rep").select("rid"), "rid", "left_anti")
    flat = reps.select("rid", F.explode("bands").alias("key"))
    heads = C.written(flat.groupBy("key").agg(F.min("rid").alias("head"), F.count("*").alias("size")).where("size > 1")
                      .select("key", "head"), "heads")
    cells = C.written(flat.join(heads, "key"), "cells")
    pairs = C.written(cells.where("rid <> head").select(F.col("head").alias("a"), F.col("rid").alias("b")).distinct(), "pairs")
    comp = None
    if not pairs.isEmpty():
        size = rows.select(F.col("rid").alias("b"), F.col("n").alias("nb"))
        fit = pairs.join(size, "b").join(size.withColumnsRenamed({"b": "a", "nb": "na"}), "a").where(
            f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)").select("a", "b")
        fit = C.written(fit, "fitting")
        ids = C.written(cells.select("rid").distinct(), "candidates")
        wanted = C.written(named.where("rid = rep").join(C.small(ids), "rid", "left_semi").select(
            "rid", "doc_id", "s1", "s2"), "wanted")
        full = _member_sets(docs, wanted, id_col, text_col)
        comp = C.written(components(C.written(confirmed(fit, full), "links")), "components")
        for forest in (True, False):  # first as few pairs as can join the groups, then every pair that is left
            left = C.written(open_pairs(cells.select("key", "rid"), comp, rows, block, forest), "open-pairs")
            if left.isEmpty():
                break
            found = C.written(confirmed(left, full), "links")
            if not found.isEmpty():
                comp = _joined(comp, found)
    named = named.select("doc_id", "n", "rep")
    named = named.withColumn("component", F.col("rep")) if comp is None else with_component(named, "rep", comp)
    named = C.written(named, "in-component")
    low = C.written(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "names")
    done = named.join(low, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(
        rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
    return done.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
