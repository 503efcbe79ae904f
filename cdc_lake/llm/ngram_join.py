"""N-gram Jaccard join by parity sketches (operator 7).

A document's set is its distinct 5-word shingles.  Two sets with Jaccard similarity >= 0.75 differ in at most
T = (|A| + |B|) / 7 members.  The members are hashed into C > T cells, and each cell holds the XOR of its members'
hashes: a parity sketch, in which every differing member changes at most one cell, so the number of differing cells
never exceeds the symmetric difference.  By the pigeonhole principle at least C - T cells of a linked pair are equal.

*Size bands.*  Bands grow by 4/3, so the sizes of a linked pair lie in one band or two neighbouring ones.  Every set
is sketched for the band pair it leads and the one it follows, each with its own T and C.  Bands whose sets exceed
``SKETCH`` members sketch a hashed share of the members; there T is the mean of the sampled difference of the widest
pair plus ``DEVIATIONS`` standard deviations (the widest pair at the very threshold is missed with probability 8e-6 at
most, by the binomial tail, pairs above it with much less; bands of smaller sets are exact).

*Join.*  Of the C cells, T + 1 suffice for a common one, so each set keeps its T + 1 rarest cells: cells that occur
once are dropped (most documents have more than T of them and are done), and so are cells made of boilerplate.
Empty cells come last and are never joined: a set with no more than T filled cells is sketched again from four times
the share of its members, down to all of them, which compares it with the other such sets; every other set it meets
in a filled cell.

Cells are then stars, not cliques: per cell, members are compared with the smallest member, true links are verified
on the full sets, and components are formed.  What is left are members of one cell in different components.  Each
gets its largest cell as home, homes that meet in a cell are compared block against block by a second parity sketch
of ``BITS`` bits of the whole sets, whose Hamming distance must not exceed the allowed difference, and only pairs
that pass are emitted and verified.  So no link between different sets is lost, copies and near copies cost rows in
proportion to their number, and no cell's pairs are written out.

Sets are compared by 64-bit shingle hashes; equal sets are collapsed first (by 128 bits).

Cases: null texts and texts without words have empty sets and link with nothing; a text of one to four words has its
whole sequence as one shingle; a null doc_id is never a component's name unless all its members are null.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common as C
from . import wordhash as H
from .components import components

SKETCH = 96
DEVIATIONS = 4.5
FINER = 4.0     # growth of the sketched share for sets with too few filled cells
BITS = 1024     # bits of the parity sketch that filters pairs
BLOCK = 1024    # members of a home compared at a time, about
FEW = 64        # members of a small pair of blocks


@lru_cache(maxsize=1)
def band_starts() -> np.ndarray:
    """Smallest size of every band: ceil((4/3)**k), up to 2**40."""
    out, k = [], 0
    while not out or out[-1] < 1 << 40:
        out.append(-(-4 ** k // 3 ** k))
        k += 1
    return np.array(out, np.int64)


@lru_cache(maxsize=4096)
def plan(band: int, tier: int = 0) -> tuple[float, int, int]:
    """(sketched share p, threshold T, cells C) for pairs whose smaller set lies in ``band``."""
    starts = band_starts()
    low, small = int(starts[band]), max(int(starts[band + 1]) - 1, 1)
    p = min(1.0, SKETCH / low * FINER ** tier)
    apart = (small + 4 * small // 3) // 7
    if p == 1.0:
        return p, apart, max(4 * low, apart + 1, 16) if tier else max(2 * low, apart + 1, 16)
    apart = math.ceil(apart * p + DEVIATIONS * math.sqrt(apart * p * (1 - p)) + 1)
    least, cells = low * p, apart + 1
    while cells * (1 - math.exp(-least / cells)) < 1.08 * apart + 1 and cells < 4 * least:
        cells += max(1, cells // 16)
    return p, apart, cells


def sketch(values: np.ndarray, offsets: np.ndarray, follow: int, tier: int, among: np.ndarray):
    """Cell keys of the sets ``among`` for the band pair they lead (follow=0) or follow (follow=1).

    Returns keys, offsets (one slot per set), T, the number of empty cells among the keys (the last ones of a set,
    only for sets that are sketched whole and still fill no more than T cells), and the sets that need a finer tier.
    """
    sizes = np.diff(offsets)
    starts = band_starts()
    band = np.searchsorted(starts, sizes, side="right") - 1 - follow
    band[(sizes == 0) | (band < 0) | ~among] = -1
    plans = {b: plan(b, tier) for b in np.unique(band).tolist() if b >= 0}
    of = [plans.get(b, (0.0, 0, 0)) for b in band.tolist()]
    share = np.array([x[0] for x in of])
    apart, cells = (np.array([x[k] for x in of], np.int64) for k in (1, 2))
    own = np.repeat(np.arange(len(sizes)), sizes)
    h = H.mix(values + H.U(0x5EED))
    live = (band[own] >= 0) & ((h >> H.U(11)).astype(np.float64) < share[own] * 2.0 ** 53)
    own, h, values = own[live], H.mix(h[live]), values[live]
    base = np.concatenate(([0], np.cumsum(cells)))
    at = base[own] + ((h >> H.U(20)) % cells[own].astype(H.U)).astype(np.int64)
    parity = np.zeros(base[-1], H.U)
    np.bitwise_xor.at(parity, at, H.mix(values + H.U(0xCE11)))
    filled = parity != 0
    cell = np.flatnonzero(filled)
    row = np.searchsorted(base, cell, side="right") - 1
    n_filled = np.bincount(row, minlength=len(sizes))
    short = (band >= 0) & (n_filled <= apart)
    whole = short & (share == 1.0)
    if whole.any():  # practically never: the first empty cells in the common order of cells
        empty = np.flatnonzero(~filled)
        of_row = np.searchsorted(base, empty, side="right") - 1
        first = np.searchsorted(empty, base[:-1])
        take = whole[of_row] & (np.arange(len(empty)) - first[of_row] <= (apart - n_filled)[of_row])
        cell, row = np.concatenate((cell, empty[take])), np.concatenate((row, of_row[take]))
        order = np.argsort(row, kind="stable")
        cell, row = cell[order], row[order]
    tag = ((band[row] * 8 + tier).astype(H.U) * H.U(2654435761) + (cell - base[row]).astype(H.U)) * H.U(0x9E3779B97F4A7C15)
    counts = np.bincount(row, minlength=len(sizes))
    return (H.mix(parity[cell] ^ H.mix(tag)), np.concatenate(([0], np.cumsum(counts))), apart, counts - n_filled,
            short & ~whole)


def _sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    values, own = H.shingles(*H.words(texts), C.SHINGLE_WORDS)
    return H.unique_sets(values, own, len(texts))


SKETCHES = "array<struct<t:int,empty:int,keys:array<long>>>"


def _parity(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Parity sketch of the whole sets, ``BITS`` bits each."""
    n = len(offsets) - 1
    h = H.mix(values + H.U(0xB175))
    words = np.zeros((n, BITS // 64), H.U)
    at = (np.repeat(np.arange(n), np.diff(offsets)), ((h >> H.U(6)) % H.U(BITS // 64)).astype(np.int64))
    np.bitwise_xor.at(words, at, H.U(1) << (h & H.U(63)))
    return pa.array([w.tobytes() for w in words], pa.binary())


def _sketches(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """All sketches of every set, as a list of (T, empty cells, keys)."""
    n = len(offsets) - 1
    parts = []  # (set, T, empty, keys, offsets) of every round
    for follow in (0, 1):
        among, tier = np.ones(n, bool), 0
        while among.any():
            keys, ko, apart, empty, among_next = sketch(values, offsets, follow, tier, among)
            have = np.flatnonzero(np.diff(ko))
            parts.append((have, apart[have], empty[have], [keys[ko[i]:ko[i + 1]] for i in have]))
            among, tier = among_next, tier + 1
    row = np.concatenate([p[0] for p in parts])
    order = np.argsort(row, kind="stable")
    lists = [k for p in parts for k in p[3]]
    lists = [lists[i] for i in order]
    keys = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum([len(k) for k in lists]))).astype(np.int32), pa.int32()),
        pa.array(H.signed(np.concatenate(lists)) if lists else [], pa.int64()))
    struct = pa.StructArray.from_arrays(
        [*(pa.array(np.concatenate([p[k] for p in parts])[order], pa.int32()) for k in (1, 2)), keys], ["t", "empty", "keys"])
    per = np.searchsorted(row[order], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(per, pa.int32()), struct)


def sketched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: row number, doc_id, set size, 128-bit set hash and its sketches."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in H.slices(batch, 1):
                values, offsets = _sets(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(offsets), pa.int64()),
                     *(pa.array(H.signed(H.fold(values, offsets, seed))) for seed in (1, 2)), _sketches(values, offsets),
                     _parity(values, offsets)], ["doc_id", "n", "s1", "s2", "sketches", "parity"])

    return rows.mapInArrow(run, f"doc_id {kind}, n long, s1 long, s2 long, sketches {SKETCHES}, parity binary").withColumn(
        "rid", F.monotonically_increasing_id())


def shared_cells(reps: DataFrame) -> DataFrame:
    """(key, rid): the T + 1 rarest cells of every sketch, of those that occur more than once."""
    flat = reps.select("rid", F.posexplode("sketches").alias("side", "k")).select("rid", "side", "k.*")
    often = C.written(flat.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n"))
                      .where("n > 1"), "cells")
    own = flat.select("rid", "side", "t", F.size("keys").alias("all"), (F.size("keys") - F.col("empty")).alias("filled"),
                      F.posexplode("keys").alias("pos", "key"))
    own = own.select("rid", "side", "t", "all", (F.col("pos") >= F.col("filled")).alias("empty"), "key").join(often, "key")
    w = W.partitionBy("rid", "side")  # the cells of one sketch
    own = own.withColumn("place", F.row_number().over(w.orderBy("empty", "n", "key"))).withColumn("seen", F.count("*").over(w))
    # Cells that occur once come first in the order; there are all - seen of them.
    own = own.where(F.col("place") + F.col("all") - F.col("seen") <= F.col("t") + 1)
    return C.written(own.select("key", "rid").distinct(), "shared")


def _member_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rid, set as bytes) of the wanted representatives (rid, doc_id, s1, s2), from their texts."""
    wanted = C.small(wanted)
    ids = C.small(C.written(wanted.select(F.col("doc_id").alias("_id")).distinct(), "wanted-ids"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
        ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def run(batches):
        for batch in batches:
            for part in H.slices(batch, 0):
                values, offsets = _sets(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(H.signed(H.fold(values, offsets, seed))) for seed in (1, 2)),
                     pa.array([values[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())],
                    ["s1", "s2", "members"])

    sets = rows.select("text").mapInArrow(run, "s1 long, s2 long, members binary")
    return C.written(sets.join(wanted.select("rid", "s1", "s2"), ["s1", "s2"]).select("rid", "members")
                     .dropDuplicates(["rid"]), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int = 75) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, H.U), np.frombuffer(y, H.U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # The larger side of the join is the pairs; both are written tables, so a hub's pairs can be split.
    first = pairs.join(sets.select(F.col("rid").alias("b"), F.col("members").alias("y")), "b")
    both = first.join(sets.select(F.col("rid").alias("a"), F.col("members").alias("x")), "a")
    return both.mapInArrow(run, "a long, b long")


def _relinked(comp: DataFrame, found: DataFrame) -> DataFrame:
    """``comp`` after the further links ``found`` (a, b): components of components."""
    ends = found.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
    known = C.written(_with_component(ends, "rid", comp), "linked")
    e = found.join(known.select(F.col("rid").alias("a"), F.col("component").alias("ca")), "a").join(
        known.select(F.col("rid").alias("b"), F.col("component").alias("cb")), "b")
    top = C.written(components(e.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).select(
        F.col("node").alias("_n"), F.col("component").alias("_c")), "top")
    both = comp.unionByName(known.select(F.col("rid").alias("node"), "component")).distinct()
    return C.written(both.join(C.small(top), F.col("component") == F.col("_n"), "left").select(
        "node", F.coalesce("_c", "component").alias("component")), "components")


def _close(table) -> pa.Table:
    """Pairs (a, b) of different components from pairs of blocks (x, y), by the Hamming distance of the parity sketches."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row in table.to_pylist():
        x, y = ({k: np.array([m[k] for m in row[side]], np.int64) for k in ("rid", "component", "n")} for side in "xy")
        px, py = (np.frombuffer(b"".join(m["parity"] for m in row[side]), H.U).reshape(-1, BITS // 64) for side in "xy")
        for k in range(len(px)):
            near = 7 * np.bitwise_count(px[k] ^ py).sum(1, dtype=np.int64) <= x["n"][k] + y["n"]
            near &= (x["component"][k] != y["component"]) & (
                (3 * x["n"][k] <= 4 * y["n"]) & (3 * y["n"] <= 4 * x["n"][k]))
            hit = y["rid"][near]
            a.append(np.minimum(x["rid"][k], hit))
            b.append(np.maximum(x["rid"][k], hit))
    return pa.table([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())], ["a", "b"])


def _close_rows(batches):
    for batch in batches:
        yield from _close(batch).to_batches()


def _rest(members: DataFrame, comp: DataFrame, nodes: DataFrame) -> DataFrame:
    """Close pairs (a, b) of members of one cell in different components; ``nodes``: rid, n, parity."""
    own = C.written(_with_component(members, "rid", comp), "members")
    open_ = C.written(own.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                             F.count("*").alias("size")).where("lo <> hi").select("key", "size"), "open")
    own = C.written(own.join(C.small(open_), "key"), "open-members")
    homes = C.written(own.groupBy("rid").agg(F.max(F.struct("size", "key")).alias("h"), F.first("component").alias("component"))
                      .select("rid", "component", F.col("h.key").alias("home")), "homes")
    big = homes.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    homes = C.written(homes.join(C.written(big, "home-parts"), "home").withColumn(
        "part", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")), "homes")
    # Blocks that meet in a cell: the members of a cell have few homes, most of them the cell itself.
    at = C.written(own.select("key", "rid").join(homes.select("rid", "home", "part"), "rid").select(
        "key", "home", "part").distinct(), "cell-blocks")
    left, right = (at.select("key", F.col("home").alias(f"h{k}"), F.col("part").alias(f"p{k}")) for k in (0, 1))
    meet = C.written(left.join(right, "key").where("h0 < h1 OR (h0 = h1 AND p0 <= p1)").select(
        "h0", "p0", "h1", "p1").distinct(), "meeting")
    blocks = C.written(homes.join(nodes, "rid").groupBy("home", "part").agg(
        F.collect_list(F.struct("rid", "component", "n", "parity")).alias("m")), "blocks")  # about BLOCK members each
    x, y = (blocks.select(F.col("home").alias(f"h{k}"), F.col("part").alias(f"p{k}"), F.col("m").alias(v))
            for k, v in ((0, "x"), (1, "y")))
    sized = meet
    for k in (0, 1):
        sized = sized.join(blocks.select(F.col("home").alias(f"h{k}"), F.col("part").alias(f"p{k}"), F.size("m").alias(f"k{k}")),
                           [f"h{k}", f"p{k}"])
    sized = C.written(sized, "meeting-sizes")
    few = F.col("k0") + F.col("k1") <= FEW

    def both(cond) -> DataFrame:
        return sized.where(cond).join(x, ["h0", "p0"]).join(y, ["h1", "p1"])

    # Large pairs of blocks go to Python one by one, small ones in batches.
    small = both(few).select("x", "y").mapInArrow(_close_rows, "a long, b long")
    large = both(~few).groupBy("h0", "p0", "h1", "p1").applyInArrow(
        lambda t: _close(t.select(["x", "y"])), "a long, b long")
    return small.unionByName(large).distinct()


def links(cells: DataFrame, nodes: DataFrame, sets_of) -> DataFrame | None:
    """(node, component) of all nodes with a verified link, from the members (key, rid) of shared cells; None without
    any candidate pair.  ``nodes``: rid, n, parity of all nodes."""
    heads = C.written(cells.groupBy("key").agg(F.min("rid").alias("a")), "heads")
    pairs = C.written(cells.join(heads, "key").where("rid <> a").select("a", F.col("rid").alias("b")).distinct(), "pairs")
    if pairs.isEmpty():
        return None
    comp = C.written(components(C.written(_verified(pairs, sets_of()), "links")), "components")
    rest = C.written(_rest(cells, comp, nodes).join(
        pairs.withColumnsRenamed({"a": "pa", "b": "pb"}), (F.col("a") == F.col("pa")) & (F.col("b") == F.col("pb")), "left_anti"),
        "rest")
    if not rest.isEmpty():
        found = C.written(_verified(rest, sets_of()), "links")
        if not found.isEmpty():
            comp = _relinked(comp, found)
    return comp


def _with_component(rows: DataFrame, node: str, comp: DataFrame) -> DataFrame:
    """``rows`` with the component of column ``node`` (itself if it has no link)."""
    c = C.small(comp).select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    return rows.join(c, F.col(node) == F.col("_n"), "left").withColumn(
        "component", F.coalesce("_c", node)).drop("_n", "_c")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    rows = C.written(sketched(docs, id_col, text_col), "sketches")
    classes = C.written(rows.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("rid").alias("rep")), "classes")
    copies = C.written(rows.where("n > 0").select("rid").join(
        classes.select(F.col("rep").alias("rid")), "rid", "left_anti").select(F.col("rid").alias("_copy")), "copies")
    reps = C.anti_rows(rows.where("n > 0"), F.col("rid"), copies, "_copy")
    cells = shared_cells(reps)
    made: list[DataFrame] = []

    def sets_of() -> DataFrame:
        if not made:
            ids = C.written(cells.select("rid").distinct(), "candidates")
            made.append(_member_sets(docs, C.written(rows.select("rid", "doc_id", "s1", "s2").join(
                C.small(ids), "rid", "left_semi"), "wanted"), id_col, text_col))
        return made[0]

    comp = links(cells, rows.select("rid", "n", "parity"), sets_of)
    named = C.written(rows.where("n > 0").select("rid", "doc_id", "n", "s1", "s2").join(
        classes, ["n", "s1", "s2"]).select("rid", "doc_id", "n", "rep"), "named")
    named = named.withColumn("component", F.col("rep")) if comp is None else _with_component(named, "rep", comp)
    named = C.written(named, "in-component")
    low = C.written(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "names")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return named.join(low, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with one document of each component: the one with the smallest doc_id (nulls last).

    A document is a doc_id with its text, so texts that share an id are decided one by one; rows that repeat both
    stay or go together.
    """
    sha = F.sha2(C.text_of(text_col), 256)
    keyed = docs.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), sha.alias("sha"))
                        .alias("doc_id"), F.col(text_col).alias("text"))
    gone = C.small(C.written(ngram_components(keyed).where("doc_id <> component_id").select(
        F.col("doc_id.id").alias("_drop_id"), F.col("doc_id.sha").alias("_drop_sha")).distinct(), "near-copies"))
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_drop_id"]) & (sha == gone["_drop_sha"]), "left_anti")
