"""Centroid clustering by subvector dictionaries (operator 13).

Every vector becomes integers (floor of ``scale`` times a component) and is cut into blocks of ``width`` neighbouring
dimensions.  Per block, the distinct subvectors of the whole table form a dictionary, and a vector is stored as its
codes: nothing is rounded, so the coding is lossless.  In a round the squared distance of every dictionary entry to
every centroid's block is computed once; a vector's distance is the sum of its codes' partial distances.  Exact
integer arithmetic throughout.

*Width.*  One pass collects the distinct subvectors of every width in ``WIDTHS``; a task gives a width up beyond
``ENTRIES`` entries in a block, so its output and the dictionary sent to the tasks are bounded (``ENTRIES`` entries for
each of at most one block per dimension).  The widest width that fits is taken.

*Without a width that fits* (more than ``ENTRIES`` distinct values in one dimension) the dictionary stays a table:
partial distances are computed per distinct (dimension, value), joined to the vectors' values and summed by vector,
and so are the centroids' sums.  Both ways give the same rows; ``entries`` lowers the bound in tests.

Centroids are ``k`` rows and travel through the driver, vectors never do.  A round reads the written codes once and
returns one row of sums per task and cluster.

Cases: rows whose vector is null, has another number of components, or holds a null or non-finite one take no part;
a null id takes part (its hash is that of ``seed:``); repeated rows are separate vectors, equal hashes are ordered by
the vector; with fewer than ``k`` vectors there are as many centroids as vectors; without any the result is empty.
Scaled components saturate at 2^62, distances and their sums at the largest long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

WIDTHS = (4, 2, 1)
ENTRIES = 4096
LIMIT = float(1 << 62)
LONG_MAX = (1 << 63) - 1


def quantised(vectors: DataFrame, id_col: str, vec_col: str, dim: int, scale: int) -> DataFrame:
    """(rid, vec_id, v): the vectors that take part, as whole numbers held in doubles."""
    x = F.col("v")
    whole = F.transform(x, lambda c: F.least(F.greatest(F.floor(F.lit(float(scale)) * c.cast("double")).cast("double"),
                                                        F.lit(-LIMIT)), F.lit(LIMIT)))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v")).where(F.size(x) == dim)
    rows = rows.where(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))))
    # A double beyond the long range is a whole number already; floor() would saturate it at 2^63.
    return rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", whole.alias("v"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows."""
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(col.flatten(), np.float64).reshape(-1, dim)


def _distinct_rows(batches, dim: int, entries: int):
    """(width, block, sub) of the distinct subvectors of a task; a width with more than ``entries`` in a block: (width,
    -1, null)."""
    seen: dict[tuple[int, int], np.ndarray] = {}
    lost: set[int] = set()
    for batch in batches:
        m = matrix(batch.column(0), dim)
        for w in WIDTHS:
            for b in range(0 if w in lost or dim % w else dim // w):
                sub = m[:, b * w:(b + 1) * w]
                have = seen.get((w, b))
                sub = np.unique(sub if have is None else np.concatenate((have, sub)), axis=0)
                if len(sub) > entries:
                    lost.add(w)
                    break
                seen[w, b] = sub
    out = [(w, -1, None) for w in sorted(lost)]
    for (w, b), sub in seen.items():
        if w not in lost:
            out += [(w, b, s) for s in sub.tolist()]
    for a in range(0, len(out), 10_000):
        part = out[a:a + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.int32()),
                                          pa.array([r[2] for r in part], pa.list_(pa.float64()))], ["width", "block", "sub"])


class Dictionary:
    """The distinct subvectors of every block (sorted) and the lossless code of a subvector: its place among them."""

    def __init__(self, width: int, subs: list[np.ndarray]):
        self.width, self.subs = width, subs
        self.axes, self.radix, self.keys = [], [], []
        for sub in subs:
            axes = [np.unique(sub[:, j]) for j in range(width)]
            radix = [int(np.prod([len(a) for a in axes[j + 1:]], dtype=object)) for j in range(width)]
            self.axes.append(axes)
            self.radix.append(radix)
            self.keys.append(self._key(sub, axes, radix))

    @staticmethod
    def _key(sub: np.ndarray, axes, radix) -> np.ndarray:
        # At most ENTRIES values per dimension and four dimensions: a key stays below 2^48.
        return sum(np.searchsorted(a, sub[:, j]).astype(np.int64) * r for j, (a, r) in enumerate(zip(axes, radix)))

    def encode(self, m: np.ndarray) -> np.ndarray:
        w = self.width
        return np.stack([np.searchsorted(self.keys[b], self._key(m[:, b * w:(b + 1) * w], self.axes[b], self.radix[b]))
                         for b in range(len(self.subs))], 1).astype(np.uint16)

    def whole(self, exact: bool) -> list[np.ndarray]:
        """The subvectors as integers: 64-bit ones, or Python's where sums of squares may pass 64 bits."""
        return [s.astype(np.int64) if exact else np.array([[int(x) for x in r] for r in s.tolist()], object) for s in self.subs]


def find_dictionary(rows: DataFrame, dim: int, entries: int) -> Dictionary | None:
    """The dictionary of the widest width with at most ``entries`` distinct subvectors in every block."""
    found = C.written(rows.select("v").mapInArrow(lambda it: _distinct_rows(it, dim, entries),
                                                  "width int, block int, sub array<double>").distinct(), "subvectors")
    per = found.groupBy("width", "block").agg(F.count("*").alias("n")).collect()
    fits = {w: [r.n for r in per if r.width == w and r.block >= 0] for w in WIDTHS
            if not any(r.width == w and r.block < 0 for r in per)}
    width = next((w for w in WIDTHS if fits.get(w) and max(fits[w]) <= entries), None)
    if width is None:
        return None
    # Bounded: at most ``entries`` rows for each of at most ``dim`` blocks.
    subs: list[list] = [[] for _ in range(dim // width)]
    for r in found.where(F.col("width") == width).select("block", "sub").toLocalIterator():
        subs[r.block].append(r["sub"])
    return Dictionary(width, [np.unique(np.array(s), axis=0) for s in subs])


def next_centroids(sums: dict[int, tuple[int, list[int]]], centroids: list[list[int]]) -> list[list[int]]:
    """Componentwise floor(sum / count) of every non-empty cluster; empty ones keep their centroid."""
    return [[s // sums[j][0] for s in sums[j][1]] if j in sums else c for j, c in enumerate(centroids)]


# ------------------------------------------------------------------ dictionary sent to the tasks
SUMS = "cluster int, n long, sums array<string>"  # sums as decimal text: exact at any size


def _assign(column: pa.Array, parts: list[np.ndarray]):
    """(codes, nearest centroid, squared distance) of coded vectors: partial distances summed by code."""
    codes = np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), len(parts))
    total = parts[0][codes[:, 0]].copy()
    for b in range(1, len(parts)):
        total += parts[b][codes[:, b]]
    best = np.argmin(total, axis=1)  # the first of equal ones
    return codes, best, total[np.arange(len(best)), best]


def _sum_rows(batches, shared):
    """One row per cluster and task: its vectors' number and componentwise sums, from counts of codes."""
    parts, subs = shared.value
    total: dict[int, tuple[int, list[int]]] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        codes, best, _ = _assign(batch.column(0), parts)
        for j in np.unique(best).tolist():
            own = codes[best == j]
            add = np.concatenate([np.bincount(own[:, b], minlength=len(s)).astype(s.dtype) @ s for b, s in enumerate(subs)])
            n, sums = total.get(j, (0, [0] * len(add)))
            total[j] = (n + len(own), [x + int(y) for x, y in zip(sums, add)])
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([n for n, _ in total.values()], pa.int64()),
         pa.array([[str(x) for x in sums] for _, sums in total.values()], pa.list_(pa.string()))], ["cluster", "n", "sums"])


def _assigned_rows(batches, shared):
    parts, _ = shared.value
    for batch in batches:
        if batch.num_rows:
            _, best, far = _assign(batch.column(1), parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.int32()), pa.array([min(int(x), LONG_MAX) for x in far], pa.int64())],
                ["vec_id", "cluster", "distance"])


class CodedRounds:
    """Rounds over the written codes; the tables of partial distances are made once a round and sent to the tasks."""

    def __init__(self, rows: DataFrame, words: Dictionary, dim: int):
        self.words, self.dim, self.sc = words, dim, rows.sparkSession.sparkContext
        self.most = max(int(np.abs(s).max()) for s in words.subs)
        self.kind = rows.schema["vec_id"].dataType.simpleString()
        shared = self.sc.broadcast(words)

        def encode(batches):
            for batch in batches:
                codes = shared.value.encode(matrix(batch.column(1), dim))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary())],
                                                 ["vec_id", "codes"])

        self.codes = C.written(rows.select("vec_id", "v").mapInArrow(encode, f"vec_id {self.kind}, codes binary"), "codes")

    def _tables(self, centroids: list[list[int]]):
        far = self.most + max(abs(x) for c in centroids for x in c)
        exact = self.dim * far * far < LONG_MAX
        subs = self.words.whole(exact)
        cents = np.array(centroids, np.int64 if exact else object)
        w = self.words.width
        parts = [((s[:, None, :] - cents[None, :, b * w:(b + 1) * w]) ** 2).sum(2) for b, s in enumerate(subs)]
        return self.sc.broadcast((parts, subs))

    def sums(self, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
        """{cluster: (vectors, componentwise sums)}: tasks x k rows of ``dim`` numbers, added up by Spark."""
        shared = self._tables(centroids)
        rows = self.codes.select("codes").mapInArrow(lambda it: _sum_rows(it, shared), SUMS)
        flat = rows.select("cluster", "n", F.posexplode("sums").alias("pos", "x"))
        got = flat.groupBy("cluster", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
        out: dict[int, tuple[int, list[int]]] = {}
        for r in got.orderBy("cluster", "pos").collect():
            out.setdefault(r.cluster, (r.n, []))[1].append(int(r.x))
        return out

    def assigned(self, centroids: list[list[int]]) -> DataFrame:
        shared = self._tables(centroids)
        return self.codes.mapInArrow(lambda it: _assigned_rows(it, shared),
                                     f"vec_id {self.kind}, cluster int, distance long")


# ------------------------------------------------------------------ dictionary as a table
class JoinedRounds:
    """Rounds for dictionaries of any size: partial distances per distinct (dimension, value), joined and summed."""

    def __init__(self, rows: DataFrame, dim: int):
        self.rows = C.written(rows, "vectors")
        self.flat = C.written(self.rows.select("rid", F.posexplode("v").alias("pos", "x")), "values")
        self.entries = C.written(self.flat.select("pos", "x").distinct(), "dictionary")
        self.dim = dim

    def _nearest(self, centroids: list[list[int]]) -> DataFrame:
        """(rid, cluster, distance)."""
        whole = "decimal(38,0)"
        cents = self.rows.sparkSession.createDataFrame(
            [(d, [str(c[d]) for c in centroids]) for d in range(self.dim)], "pos int, c array<string>")  # ``dim`` rows
        x = F.col("x").cast("long").cast("decimal(19,0)")
        part = self.entries.join(F.broadcast(cents), "pos").select(
            "pos", "x", *[((x - F.col("c")[j].cast("decimal(19,0)")) * (x - F.col("c")[j].cast("decimal(19,0)"))).cast(whole)
                          .alias(f"d{j}") for j in range(len(centroids))])
        far = self.flat.join(C.written(part, "partial"), ["pos", "x"]).groupBy("rid").agg(
            *[F.sum(f"d{j}").cast(whole).alias(f"d{j}") for j in range(len(centroids))])
        best = F.array_min(F.array(*[F.struct(F.col(f"d{j}").alias("d"), F.lit(j).alias("j")) for j in range(len(centroids))]))
        return C.written(far.select("rid", best.alias("b")).select(
            "rid", F.col("b.j").alias("cluster"),
            F.least("b.d", F.lit(LONG_MAX).cast(whole)).cast("long").alias("distance")), "nearest")

    def sums(self, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
        near = self._nearest(centroids)
        got = self.flat.join(near.select("rid", "cluster"), "rid").groupBy("cluster", "pos").agg(
            F.count("*").alias("n"), F.sum(F.col("x").cast("long").cast("decimal(38,0)")).alias("x"))
        out: dict[int, tuple[int, list[int]]] = {}
        for r in got.orderBy("cluster", "pos").collect():
            out.setdefault(r.cluster, (r.n, []))[1].append(int(r.x))
        return out

    def assigned(self, centroids: list[list[int]]) -> DataFrame:
        return self.rows.select("rid", "vec_id").join(self._nearest(centroids), "rid").select("vec_id", "cluster", "distance")


def subvector_clusters(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = 64,
                       scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1, entries: int = ENTRIES) -> DataFrame:
    """One row per vector that takes part: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    rows = C.written(quantised(vectors, id_col, vec_col, dim, scale), "whole-vectors")
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.select("v").orderBy(place, "v").limit(k).collect()
    kind = rows.schema["vec_id"].dataType
    if not first:
        return spark.createDataFrame([], T.StructType([T.StructField("vec_id", kind)])).selectExpr(
            "vec_id", "cast(null as int) AS cluster", "cast(null as long) AS distance", "cast(null as long) AS cluster_inertia",
            "cast(null as long) AS inertia", "cast(null as string) AS centroid_sha256")
    centroids = [[int(x) for x in r.v] for r in first]
    words = find_dictionary(rows, dim, entries)
    at = JoinedRounds(rows, dim) if words is None else CodedRounds(rows, words, dim)
    for _ in range(rounds):
        centroids = next_centroids(at.sums(centroids), centroids)
    done = C.written(at.assigned(centroids), "assigned")
    per = {r.cluster: int(r.s) for r in done.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # at most k rows
    whole = min(sum(per.values()), LONG_MAX)
    names = spark.createDataFrame(
        [(j, min(per.get(j, 0), LONG_MAX), whole, ",".join(map(str, c))) for j, c in enumerate(centroids)],
        "cluster int, cluster_inertia long, inertia long, c string")
    return done.join(F.broadcast(names), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("c", 256).alias("centroid_sha256"))
