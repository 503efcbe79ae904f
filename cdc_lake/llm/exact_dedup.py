"""Exact deduplication by two Bloom passes (operator 6).

Pass 1 builds, over all rows, a counting Bloom filter of the text hashes: every row hits ``HASHES`` cells out of
``bits_per_row`` per row; the hits are counted by a grouped aggregate that is combined map-side (a text with
millions of copies is one row per task) and only the cells hit at least twice are kept, packed into 4 KB bitmaps.
Pass 2 tests every row against these bitmaps.  A row with a cell hit only once has no copy: it goes straight to the
result.  Only possibly repeated rows are shuffled by their SHA-256 and grouped; false positives come out as groups
of one, so the result is exact (up to SHA-256 collisions).

The bitmaps are broadcast when their counted size is at most ``broadcast_bytes``; beyond that the narrow rows are
joined with them by bitmap number instead.  The texts themselves are read once and never shuffled.

Cases: null and empty texts are equal to each other; of rows with equal text and equal doc_id one stays; a null
doc_id loses against any other; no other column is looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

HASHES = 2
BITMAP_BYTES = 4096  # fixed by bitmap_construct_agg
BROADCAST_BYTES = 64 << 20


def _cells(h: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(h, F.lit(k)), F.lit(bits)) for k in range(HASHES)]


def _bit(bitmap: Column, pos: Column) -> Column:
    """Bit ``pos`` of a bitmap; false for a missing bitmap."""
    byte = F.conv(F.hex(F.substring(bitmap, 1 + F.shiftright(pos, 3).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, F.pmod(pos, F.lit(8)).cast("int")) == 1, F.lit(False))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Narrow table of the rows: doc_id, row number, SHA-256 of the normalised text and a 64-bit hash of it."""
    norm = C.lower_ascii(C.text_of(text_col))
    sha = docs.select(F.col(id_col).alias("doc_id"), F.sha2(norm, 256).alias("text_sha256"))
    return sha.select("doc_id", F.monotonically_increasing_id().alias("rid"), "text_sha256",
                      F.xxhash64("text_sha256").alias("h"))


def repeated_cells(fp: DataFrame, bits: int) -> DataFrame:
    """Pass 1: bitmaps (bucket, bitmap) of the filter cells hit by two rows or more."""
    hits = (fp.select(F.explode(F.array(*_cells(F.col("h"), bits))).alias("p"))
            .groupBy("p").agg(F.count("*").alias("n")).where("n >= 2"))
    return (hits.groupBy(F.bitmap_bucket_number(F.col("p")).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("p"))).alias("bitmap")))


def possibly_repeated(fp: DataFrame, cells: DataFrame, bits: int, broadcast_bytes: int) -> DataFrame:
    """Pass 2: ``fp`` with ``maybe``: all cells of the row were hit at least twice."""
    cells = C.small(cells, broadcast_bytes // BITMAP_BYTES)
    out = fp.withColumn("maybe", F.lit(True))
    for k, cell in enumerate(_cells(F.col("h"), bits)):
        side = cells.select(F.col("bucket").alias(f"b{k}"), F.col("bitmap").alias(f"m{k}"))
        out = (out.withColumn(f"p{k}", cell)
               .join(side, F.bitmap_bucket_number(F.col(f"p{k}")) == F.col(f"b{k}"), "left")
               .withColumn("maybe", F.col("maybe") & _bit(F.col(f"m{k}"), F.bitmap_bit_position(F.col(f"p{k}")))))
    return out.select(*fp.columns, "maybe")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = 16,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    fp = C.written(fingerprints(docs, id_col, text_col), "fp")
    bits = max(1 << 15, fp.count() * bits_per_row)
    cells = C.written(repeated_cells(fp, bits), "cells")
    marked = C.written(possibly_repeated(fp, cells, bits, broadcast_bytes), "marked")

    alone = marked.where("NOT maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    maybe = marked.where("maybe")
    # The largest doc_id of a text and, of its rows, the last one; nulls sort first in a struct.
    groups = C.written(maybe.groupBy("text_sha256").agg(
        F.max(F.struct("doc_id", "rid")).alias("keep"), F.count("*").alias("group_size")), "groups")
    # Both sides are written tables, so a text with very many copies is split by the adaptive skew join.
    g = groups.select(F.col("text_sha256").alias("g_sha"), "keep", "group_size")
    grouped = maybe.join(g, F.col("text_sha256") == F.col("g_sha")).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("keep.rid")).alias("kept"), "text_sha256")
    return alone.unionByName(grouped)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with one row of each text: the one with the largest doc_id.

    Rows that repeat both doc_id and text collapse to one; two texts under one doc_id are decided text by text.
    """
    norm = C.lower_ascii(C.text_of(text_col))
    out = exact_dedup(docs, id_col, text_col).groupBy("doc_id", "text_sha256").agg(
        F.max(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n"))
    out = C.written(out.where("kept = 0 OR n > 1"), "copies")
    sha = F.sha2(norm, 256)

    def side(cond: str) -> DataFrame:
        return C.small(out.where(cond).select(F.col("doc_id").alias("_drop_id"), F.col("text_sha256").alias("_drop_sha")))

    def match(d: DataFrame):
        return docs[id_col].eqNullSafe(d["_drop_id"]) & (sha == d["_drop_sha"])

    drop, twice = side("kept = 0"), side("kept = 1 AND n > 1")
    rest = docs.join(drop, match(drop), "left_anti")
    once = rest.join(twice, match(twice), "left_anti")
    again = rest.join(twice, match(twice), "left_semi")
    if twice.isEmpty():
        return once
    pick = again.groupBy(F.col(id_col), sha).agg(F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("_row"))
    return once.unionByName(pick.select("_row.*"))
