"""Hard-negative mining over anchor-clustered shared lists, as MAXIMUS does (operator 11).

Anchors (rows whose id is divisible by ``every``) are clustered by direction.  For a cluster with centre m and widest
member angle t, a candidate c at angle u from m scores at most |a| |c| cos(max(0, u - t)) with any member a.  A task
sorts its candidates by |c| cos(max(0, u - t)) once per cluster, and every member walks that one list from the top,
a stretch of candidates at a time, until what is left cannot beat the member's last place: the end is certified, so
the result is exact whatever the clusters are.

1. *Positives*: the walk over candidates of the anchor's own label keeps the best ``positives`` scores.
2. *Negatives*: the walk over the other labels keeps, for every positive, the best ``negatives`` scores s with
   low * p <= 100 * s <= high * p (p the positive's score).

A task keeps its places over all its candidates, so later stretches end earlier, and returns them once, at its end;
Spark merges the tasks' places by rank.  With many tasks, a pilot walk over one row in ``PILOT`` first finds a floor
for every last place, below which tasks return nothing; so the rows merged grow with the anchors, not with anchors
times tasks.  No pair matrix is formed, and no label, cluster or copy group is gathered in one task.

Anchors are taken in passes of about ``PASS`` (whole clusters, large ones cut by hash); a pass's anchors are what is sent to
the tasks, so that is bounded.  Cluster centres are fitted on at most ``FIT`` anchors; every anchor is assigned.

Components become floor(``scale`` * x) and scores are exact integers: in doubles where products cannot pass 2^53, else
in Python integers.

Cases: rows with a null label or vector or any null or non-finite component take no part; a null id is never an anchor
and comes last among ties; missing components of shorter vectors count as 0; repeated rows are rows of their own (equal
ids and scores are ordered by their place in the table); an anchor without positives has no rows, neither has a positive
without negatives in range; an empty table gives an empty result.  Scaled components saturate at 2^62, scores at the
limits of a long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common as C

PASS = 8_192
FIT = 4_096
CLUSTERS = 64
CHUNK = 32_768      # candidates sorted at a time in a task
STRETCH = 1_024     # candidates of a list walked at a time
PILOT = 16
MANY_TASKS = 64
NONE = np.iinfo(np.int64).max
LOW = np.iinfo(np.int64).min
SLACK = 1e-6        # radians; far above the rounding of an angle
CLAMP = float(1 << 62)

FOUND = "anchor long, slot int, score long, vec_id long, rid long"


def candidates(vectors: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int) -> DataFrame:
    """(rid, vec_id, label, v): the rows that take part, v as whole numbers held in doubles."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vec_col).alias("v")).where(F.col("label").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))))
    whole = F.transform("v", lambda c: F.least(F.greatest(F.floor(F.lit(float(scale)) * c.cast("double")).cast("double"),
                                                          F.lit(-CLAMP)), F.lit(CLAMP)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", label.alias("label"), whole.alias("v"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows of ``dim`` numbers, shorter ones filled with 0."""
    flat = np.asarray(column.flatten(), np.float64)
    sizes = np.asarray(column.value_lengths(), np.int64)
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def fit_centres(m: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of at most ``k`` clusters by direction, from a bounded sample of anchors."""
    u = _unit(m)
    centres = u[:: max(1, len(u) // k)][:k]
    for _ in range(rounds):
        own = np.argmax(u @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, u)
        new = _unit(sums)
        empty = ~new.any(axis=1)
        new[empty] = centres[empty]
        centres = new
    return centres


def _dots(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products as longs."""
    if not a.size or not c.size:
        return np.zeros((len(a), len(c)), np.int64)
    if a.shape[1] * np.abs(a).max() * np.abs(c).max() < 2.0 ** 53:
        return (a @ c.T).astype(np.int64)
    whole = [np.array([[int(x) for x in r] for r in m.tolist()], object) for m in (a, c)]
    return np.clip(whole[0] @ whole[1].T, LOW, NONE).astype(np.int64)


def _angles(u: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(u @ centre, -1.0, 1.0))


@dataclass
class Group:
    """Anchors of one cluster with what their walks look for.

    ``slots``: (member, slots) bounds lo <= score <= hi of every place list; an unused slot has lo > hi.  ``floor``: the
    score below which a slot needs nothing.
    """
    centre: np.ndarray
    m: np.ndarray
    rid: np.ndarray
    label: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    floor: np.ndarray

    def __post_init__(self):
        self.norm = np.linalg.norm(self.m, axis=1)
        u = _unit(self.m)
        self.wide = float(_angles(u, self.centre).max()) + SLACK if self.norm.all() else np.pi


class Places:
    """The best ``depth`` (score, id, rid) of every slot of a group's members, best first."""

    def __init__(self, group: Group, depth: int):
        self.depth = depth
        n, s = group.lo.shape
        self.slots = s
        self.at = [np.zeros(0, np.int64) for _ in range(4)]  # slot number, score, id, rid
        self.least = np.maximum(group.lo, group.floor)       # a score below it is of no use
        self.last_id = np.full((n, s), NONE)                 # among scores equal to ``least``: ids up to this one

    def add(self, slot: np.ndarray, score: np.ndarray, vid: np.ndarray, rid: np.ndarray) -> None:
        slot, score, vid, rid = (np.concatenate(x) for x in zip(self.at, (slot, score, vid, rid)))
        order = np.lexsort((rid, vid, -score, slot))
        slot, score, vid, rid = slot[order], score[order], vid[order], rid[order]
        first = np.searchsorted(slot, slot)
        place = np.arange(len(slot)) - first
        keep = place < self.depth
        self.at = [x[keep] for x in (slot, score, vid, rid)]
        full = place == self.depth - 1
        self.least.reshape(-1)[slot[full]] = score[full]
        self.last_id.reshape(-1)[slot[full]] = vid[full]


def walk(group: Group, places: Places, cand: np.ndarray, vid: np.ndarray, rid: np.ndarray, label: np.ndarray,
         norm: np.ndarray, unit: np.ndarray, same: bool, walked: list[int] | None = None) -> None:
    """All members walk the group's list of these candidates: those of the member's label, or of the others."""
    bound = norm * np.cos(np.maximum(0.0, _angles(unit, group.centre) - group.wide))
    order = np.lexsort((vid, -bound))
    bound, label = bound[order], label[order]
    for own in np.unique(group.label).tolist():
        members = np.flatnonzero(group.label == own)
        mine = np.flatnonzero(label == own) if same else np.flatnonzero(label != own)
        for a in range(0, len(mine), STRETCH):
            at = mine[a:a + STRETCH]
            # Nothing from here on scores above |member| * bound of the next candidate: members whose every place is
            # better are done.  Equal scores may still win by their id.
            top = group.norm[members] * bound[at[0]]
            top = top + np.abs(top) * 1e-9 + 1e-6
            used = (group.lo[members] <= group.hi[members]) & (places.least[members] <= group.hi[members])
            members = members[(used & (places.least[members] <= top[:, None])).any(1)]
            if not len(members):
                break
            if walked is not None:
                walked.append(len(members) * len(at))
            pick = order[at]
            score = _dots(group.m[members], cand[pick])
            for s in range(places.slots):
                lo, hi = places.least[members, s], group.hi[members, s]
                fit = (score >= lo[:, None]) & (score <= hi[:, None])
                if same:
                    fit &= rid[pick][None, :] != group.rid[members][:, None]
                if fit.shape[1] > places.depth:  # the last place of this stretch alone bounds what is of use
                    best = np.where(fit, score, LOW)
                    lo = np.maximum(lo, np.partition(best, -places.depth, axis=1)[:, -places.depth])
                    fit &= score >= lo[:, None]
                i, j = np.nonzero(fit)
                if not len(i):
                    continue
                sc, v = score[i, j], vid[pick][j]
                use = (sc > places.least[members, s][i]) | (v <= places.last_id[members, s][i])
                i, j, sc, v = i[use], j[use], sc[use], v[use]
                places.add(members[i] * places.slots + s, sc, v, rid[pick][j])


def _mine(batches, shared, depth: int, same: bool):
    """The best places of a task's candidates for the groups of a pass."""
    groups, dim = shared.value
    places = [Places(g, depth) for g in groups]

    def work(cols):
        ids = [np.concatenate(x) for x in zip(*[c[:3] for c in cols])]
        m = np.concatenate([c[3] for c in cols])
        norm, unit = np.linalg.norm(m, axis=1), _unit(m)
        for g, p in zip(groups, places):
            walk(g, p, m, ids[1], ids[0], ids[2], norm, unit, same)

    held, n = [], 0
    for batch in batches:
        rid = batch.column("rid").to_numpy(zero_copy_only=False)
        vid = batch.column("vec_id").fill_null(NONE).to_numpy(zero_copy_only=False)
        held.append((rid, vid, batch.column("label").to_numpy(zero_copy_only=False), matrix(batch.column("v"), dim)))
        n += batch.num_rows
        if n >= CHUNK:
            work(held)
            held, n = [], 0
    if n:
        work(held)
    for g, p in zip(groups, places):
        slot, score, vid, rid = p.at
        if len(slot):
            yield pa.RecordBatch.from_arrays(
                [pa.array(g.rid[slot // p.slots]), pa.array((slot % p.slots).astype(np.int32)), pa.array(score),
                 pa.array(vid, mask=vid == NONE), pa.array(rid)], ["anchor", "slot", "score", "vec_id", "rid"])


class Miner:
    """Walks of one pass of anchors over all candidates."""

    def __init__(self, rows: DataFrame, dim: int, total: int, tasks: int, pilot: int = PILOT, many: int = MANY_TASKS):
        self.rows, self.dim, self.pilot = rows, dim, pilot
        self.with_pilot = tasks > many and total > pilot * CHUNK or many == 0
        self.sc = rows.sparkSession.sparkContext

    def _found(self, rows: DataFrame, groups: list[Group], depth: int, same: bool) -> DataFrame:
        shared, dim = self.sc.broadcast((groups, self.dim)), self.dim  # at most one pass of anchors
        return rows.mapInArrow(lambda it: _mine(it, shared, depth, same), FOUND)

    def best(self, groups: list[Group], depth: int, same: bool, name: str) -> DataFrame:
        """(anchor, slot, place, score, vec_id, rid): the best ``depth`` places of every slot, a written table."""
        w = W.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "rid")
        place = F.row_number().over(w).alias("place")
        if self.with_pilot:
            some = self.rows.where(F.pmod(F.xxhash64("rid"), F.lit(self.pilot)) == 0)
            low = self._found(some, groups, depth, same).select("*", place).where(F.col("place") == depth).select(
                "anchor", "slot", "score").collect()  # a number per slot of the pass
            floors = {(r.anchor, r.slot): r.score for r in low}
            for g in groups:
                for i, a in enumerate(g.rid.tolist()):
                    for s in range(g.lo.shape[1]):
                        g.floor[i, s] = floors.get((a, s), LOW)
        found = self._found(self.rows, groups, depth, same)
        return C.written(found.select("*", place).where(F.col("place") <= depth), name)


def _groups(anchors, centres: np.ndarray, dim: int) -> list[Group]:
    """The groups of one pass from its collected anchors (rid, label, cluster, v)."""
    out = []
    by: dict[int, list] = {}
    for r in anchors:
        by.setdefault(r.cluster, []).append(r)
    for c, own in sorted(by.items()):
        m = np.zeros((len(own), dim))
        for i, r in enumerate(own):
            m[i, :len(r.v)] = r.v
        out.append(Group(centres[c], m, np.array([r.rid for r in own], np.int64), np.array([r.label for r in own], np.int64),
                         np.full((len(own), 1), LOW), np.full((len(own), 1), NONE), np.full((len(own), 1), LOW)))
    return out


def _ceil_floor(p: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest whole s with low * p <= 100 * s <= high * p, without overflow."""
    lo = [-(-low * int(x) // 100) for x in p]
    hi = [high * int(x) // 100 for x in p]
    return np.array(lo, np.int64), np.array(hi, np.int64)


def _with_windows(groups: list[Group], top, positives: int, low: int, high: int) -> list[Group]:
    """The same groups with a slot per positive: the range of its negatives' scores."""
    at = {(r.anchor, r.place): r.score for r in top}
    for g in groups:
        n = len(g.rid)
        g.lo, g.hi = np.full((n, positives), NONE), np.full((n, positives), LOW)
        g.floor = np.full((n, positives), LOW)
        for i, a in enumerate(g.rid.tolist()):
            have = np.array([at[a, p + 1] for p in range(positives) if (a, p + 1) in at], np.int64)
            g.lo[i, :len(have)], g.hi[i, :len(have)] = _ceil_floor(have, low, high)
    return groups


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
                   scale: int = 256, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   clusters: int = CLUSTERS, per_pass: int = PASS, many_tasks: int = MANY_TASKS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    rows = C.written(candidates(vectors, id_col, label_col, vec_col, scale), "candidates")
    anchor = F.col("vec_id") % every == 0
    total, dim, n = rows.agg(F.count("*"), F.max(F.size("v")), F.count_if(anchor)).first()
    out = ("SELECT cast(null as long) AS anchor_id, cast(null as long) AS positive_id, cast(null as int) AS rank, "
           "cast(null as long) AS negative_id, cast(null as long) AS positive_score, cast(null as long) AS negative_score")
    if not n or not dim:
        return spark.sql(out).limit(0) if not n else _zero_vectors(rows, anchor)
    sample = rows.where(anchor).select("rid", "v").orderBy(F.xxhash64("rid")).limit(FIT).collect()
    m = np.zeros((len(sample), dim))
    for i, r in enumerate(sample):
        m[i, :len(r.v)] = r.v
    centres = fit_centres(m, max(1, min(clusters, len(sample) // 4)))
    miner = Miner(rows, dim, total, rows.rdd.getNumPartitions(), many=many_tasks)

    def assign(batches):
        for b in batches:
            own = np.argmax(_unit(matrix(b.column("v"), dim)) @ centres.T, axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own, pa.int32())], [*b.schema.names, "cluster"])

    anchors = C.written(rows.where(anchor).select("rid", "vec_id", "label", "v").mapInArrow(
        assign, "rid long, vec_id long, label long, v array<double>, cluster int"), "anchors")
    parts = {r.cluster: -(-r.n // per_pass) for r in anchors.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    part = F.create_map(*[F.lit(x) for kv in parts.items() for x in kv])
    piece = anchors.withColumn("part", F.pmod(F.xxhash64("rid"), F.element_at(part, F.col("cluster"))).cast("int"))
    passes, have = [[]], 0
    for r in piece.groupBy("cluster", "part").agg(F.count("*").alias("n")).orderBy("cluster", "part").collect():
        if have and have + r.n > per_pass:
            passes.append([])
            have = 0
        passes[-1].append((r.cluster, r.part))
        have += r.n
    done = None
    for wanted in passes:
        own = piece.where(F.struct("cluster", "part").isin([F.struct(F.lit(c), F.lit(p)) for c, p in wanted]))
        groups = _groups(own.select("rid", "label", "cluster", "v").collect(), centres, dim)  # about ``per_pass`` rows
        top = miner.best(groups, positives, True, "positives")
        groups = _with_windows(groups, top.select("anchor", "place", "score").collect(), positives, low, high)
        neg = miner.best(groups, negatives, False, "negatives")
        pos = top.select("anchor", (F.col("place") - 1).alias("slot"), F.col("vec_id").alias("positive_id"),
                         F.col("score").alias("positive_score"))
        got = neg.join(pos, ["anchor", "slot"]).join(own.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id")),
                                                     "anchor")
        got = got.select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"),
                         F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        done = got if done is None else done.unionByName(got)
    return done


def _zero_vectors(rows: DataFrame, anchor) -> DataFrame:
    """All vectors without components score 0: the same walk over vectors of one component, 0."""
    zero = rows.withColumn("v", F.array(F.lit(0.0)))
    return hard_negatives(zero, "vec_id", "label", "v")
