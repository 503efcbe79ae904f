"""Sharding by a k-d tree over document metadata (operator 5).

The tree's points are the groups of equal texts, each with its bytes as weight and four metadata coordinates, scaled
to the same 24 bits: log of the size, characters per byte, language and source.  A node of p shards is cut along its
widest coordinate where the left side has p//2 of the node's p shares of bytes, until every leaf is one shard.  Cuts
are weighted quantiles found exactly by radix refinement: each round groups the points by the next 15 bits of their
(coordinate, hash) key with partial aggregation, so a round moves a bounded histogram and no rows.  Law: ``bytes``.

A group heavier than ``split_share`` of a shard (at most shards / split_share groups) is cut into that many hashed
pieces, so a text with very many copies spoils neither the balance nor one task; all other groups stay whole.

Cases: null texts have size 1; null metadata counts as empty or 0; repeated rows are placed each; fewer groups than
shards leave some shards empty.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from . import common as C

BITS, ROUNDS = 15, 4          # 24 bits of coordinate, 36 bits of hash
DIMS = ("size", "ratio", "lang", "source")
SLOT_ROWS = 20_000
FILES, POINTS_PER_FILE = 8, 500_000


def _unit(col: Column) -> Column:
    """A number in [0, 1] as 24 bits."""
    return F.floor(F.least(F.greatest(col, F.lit(0.0)), F.lit(0.9999999)) * (1 << 24)).cast("long")


def _code(col: Column) -> Column:
    """A category as 24 bits (hashed; the same value everywhere)."""
    return F.shiftright(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), 8).cast("long")


def metadata(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Narrow table: doc_id, row number, size, text_crc32, hash of the text and the four coordinates."""
    text, has = C.text_of(text_col), set(docs.columns)
    size = (F.octet_length(text) + 1).cast("long")
    col = {c: F.col(c) if c in has else F.lit(None) for c in ("lang", "source")}
    # A column of this name that is no number is some other column.
    counted = "n_chars" in has and isinstance(docs.schema["n_chars"].dataType, T.NumericType)
    chars = F.col("n_chars") if counted else F.char_length(text)
    return docs.select(
        F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"), size.alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("g"),
        _unit(F.log2(size) / 32).alias("v_size"), _unit(F.coalesce(chars, F.lit(0)) / size).alias("v_ratio"),
        _code(col["lang"]).alias("v_lang"), _code(col["source"]).alias("v_source"))


def _points(rows: DataFrame) -> DataFrame:
    """One weighted point per group piece."""
    return rows.groupBy("g", "text_crc32", "piece").agg(
        F.sum("size").alias("weight"), *[F.min(f"v_{d}").alias(f"v_{d}") for d in DIMS]).withColumn(
        "tie", F.shiftrightunsigned(F.xxhash64("g", "piece", "text_crc32"), 28)).withColumn("node", F.lit(1).cast("long"))


def _nodes(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A broadcast table of one row per open node (at most one per shard), from literals."""
    return F.broadcast(spark.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(v).cast("long").alias(k) for k, v in zip(names, r)]) for r in rows]))))


def _cut(points: DataFrame, nodes: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """One level: cut every node (number -> shards) of more than one shard."""
    spark = points.sparkSession
    open_ = {n: p for n, p in nodes.items() if p > 1}
    out = {n: p for n, p in nodes.items() if p == 1}
    for n, p in open_.items():
        out |= {2 * n: p // 2, 2 * n + 1: p - p // 2}
    wide = points.groupBy("node").agg(
        F.sum("weight").alias("weight"), *[(F.max(f"v_{d}") - F.min(f"v_{d}")).alias(d) for d in DIMS])
    state = {}
    for r in wide.collect():  # one row per node, at most as many as shards
        if p := open_.get(r["node"]):
            best = max(range(len(DIMS)), key=lambda k: r[DIMS[k]])
            state[r["node"]] = [best, 0, int(r["weight"]) * (p // 2) // p]
    if not state:
        return points, out
    dims = _nodes(spark, [(n, s[0] + 1) for n, s in state.items()], ["node", "dim"])
    value = F.element_at(F.array(*[F.col(f"v_{d}") for d in DIMS]), F.col("dim").cast("int"))
    keyed = points.join(dims, "node", "left").withColumn("k", F.shiftleft(value, 36).bitwiseOR(F.col("tie"))).drop("dim")
    for rnd in range(ROUNDS):
        shift = BITS * (ROUNDS - 1 - rnd)
        at = _nodes(spark, [(n, s[1], s[2]) for n, s in state.items()], ["node", "prefix", "want"])
        hist = (keyed.join(at, "node").where(F.shiftright("k", shift + BITS) == F.col("prefix"))
                .groupBy("node", "want", F.shiftright("k", shift).alias("b")).agg(F.sum("weight").alias("w")))
        cum = hist.withColumn("cum", F.sum("w").over(W.partitionBy("node").orderBy("b")))  # 2**15 rows per node
        got = cum.where("cum >= want").groupBy("node").agg(F.min_by(F.struct("b", "w", "cum"), "b").alias("x"))
        for r in got.collect():  # one row per node
            s, x = state[r["node"]], r["x"]
            s[1], s[2] = x["b"], s[2] - (x["cum"] - x["w"])
            if rnd == ROUNDS - 1 and x["w"] - s[2] > s[2]:
                s[1] -= 1  # nearer without the crossing point
    keys = _nodes(spark, [(n, s[1]) for n, s in state.items()], ["node", "cut"])
    child = F.when(F.col("cut").isNull(), F.col("node")).otherwise(F.col("node") * 2 + (F.col("k") > F.col("cut")).cast("int"))
    new = keyed.join(keys, "node", "left").withColumn("node", child).drop("k", "cut").persist(StorageLevel.MEMORY_AND_DISK)
    new.count()  # kept before the level above is let go; a lost executor's part is derived anew
    points.unpersist()
    return new, out


def kd_shards(docs: DataFrame, shards: int = 8, target_bytes: int | None = None, id_col: str = "doc_id",
              text_col: str = "text", split_share: float = 1 / 32) -> DataFrame:
    """Every row with its shard and slot; ``target_bytes`` sets the number of shards from the total size."""
    base = C.written(metadata(docs, id_col, text_col), "kd-rows")
    total = base.agg(F.sum("size")).first()[0] or 0
    if target_bytes:
        shards = max(1, -(-total // target_bytes))
    limit = total / shards * split_share
    heavy = C.small(C.written(base.groupBy("g", "text_crc32").agg(F.sum("size").alias("w")).where(F.col("w") > limit)
                    .select("g", "text_crc32", F.ceil(F.col("w") / limit).cast("int").alias("pieces")), "kd-heavy"))
    rows = base.join(heavy, ["g", "text_crc32"], "left").withColumn(
        "piece", F.pmod(F.xxhash64("doc_id", "rid"), F.coalesce(F.col("pieces"), F.lit(1))).cast("int")).drop("pieces")
    files = max(FILES, -(-base.count() // POINTS_PER_FILE))
    points, nodes = C.written(_points(rows).coalesce(files), "kd-points").persist(StorageLevel.MEMORY_AND_DISK), {1: shards}
    while max(nodes.values()) > 1:
        points, nodes = _cut(points, nodes)
    order = sorted(nodes, key=lambda n: bin(n)[3:])
    number = _nodes(docs.sparkSession, [(n, i) for i, n in enumerate(order)], ["node", "shard"])
    leaves = C.written(points.join(number, "node").select("g", "text_crc32", "piece", F.col("shard").cast("int"))
                       .coalesce(files), "kd-leaves")
    points.unpersist()
    placed = rows.join(leaves, ["g", "text_crc32", "piece"])

    # Gapless slots: row numbers within bounded hash buckets of a shard, plus the rows of the buckets before.
    buckets = max(1, -(-base.count() // (shards * SLOT_ROWS)))
    placed = C.written(placed.coalesce(files).select("doc_id", "rid", "size", "text_crc32", "shard", F.pmod(
        F.xxhash64("rid", "doc_id"), F.lit(buckets)).alias("bucket")), "kd-placed")
    before = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n")).withColumn(
        "start", F.sum("n").over(W.partitionBy("shard").orderBy("bucket")) - F.col("n")).drop("n")
    number = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("rid"))
    return (placed.withColumn("no", number).join(C.small(C.written(before, "kd-slots")), ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("start") + F.col("no") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
