"""Which files can hold a key: a sidecar table of key ranges and Bloom filters, one entry per data file.

A file's entry has its smallest and largest key, its number of rows, and a
blocked Bloom filter: ``slots`` bitmaps of ``SLOT_BITS`` bits, a key sets
``PROBES`` bits of the one slot that its hash names.  The bitmaps are built by
Spark's bitmap aggregate (combined map-side) and looked up by one filter over the
sidecar; only the names of files that may hold the key reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT_BITS = 32_768      # bits of Spark's bitmap aggregate
PROBES = 4
BITS_PER_KEY = 12       # a key that is not in the file passes with probability below 1 %


def key_hash(key: Column, salt: int) -> Column:
    """Hash of a key's text, so that 7 as int, long or literal is one key."""
    return F.xxhash64(key.cast("string"), F.lit(salt))


def _bit(key: Column, probe: int) -> Column:
    return F.pmod(key_hash(key, 100 + probe), F.lit(SLOT_BITS))


def _slot(key: Column, slots: Column) -> Column:
    return F.pmod(key_hash(key, 99), slots)


def file_index(rows: DataFrame, key: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """(file, extra.., lo, hi, rows, slots, slot, bits) of a written table ``rows``: one row per file and used slot."""
    own = rows.select(F.col("_metadata.file_path").alias("file"), *extra, F.col(key).alias("k"))
    stats = own.groupBy("file", *extra).agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("rows"))
    stats = stats.withColumn("slots", F.ceil(F.col("rows") * BITS_PER_KEY / SLOT_BITS))
    bits = own.where(F.col("k").isNotNull()).join(stats.select("file", "slots"), "file").select(
        "file", _slot(F.col("k"), F.col("slots")).alias("slot"),
        F.explode(F.array(*[_bit(F.col("k"), i) for i in range(PROBES)])).alias("p"))
    # Positions of the aggregate count from 0 within a slot.
    maps = bits.groupBy("file", "slot").agg(F.bitmap_construct_agg("p").alias("bits"))
    return stats.join(maps, "file", "left")


def may_hold(index: DataFrame, value) -> DataFrame:
    """The entries of ``index`` whose file can hold the key ``value``."""
    v = F.lit(value)
    hit = (F.col("lo") <= v) & (v <= F.col("hi")) & (F.col("slot") == _slot(v, F.col("slots")))
    for i in range(PROBES):
        p = _bit(v, i)
        byte = F.conv(F.hex(F.substring("bits", F.floor(p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = hit & (F.expr("1") == F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(p, F.lit(8)))), F.lit(2)))
    return index.where(hit)
