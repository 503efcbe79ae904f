"""Helpers shared by the operators: text normalisation, written tables, checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdc_lake.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of the shingle operators: runs of anything but space and \t \n \v \f \r.
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"
WORD_SPACE = " \t\n\x0b\x0c\r"
SHINGLE_WORDS = 5
SIMILARITY = 0.75
#: A table is broadcast only after its rows were counted and found to be at most this many.
BROADCAST_ROWS = 200_000
ARROW_BATCH, ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of an installed public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does just that on pure ASCII text (bytes == characters) and is much
    faster than ``translate``, which handles the rest."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, UPPER.lower()))


def words_of(col: Column) -> Column:
    """Lower-cased (A-Z) words of a text, in order; empty array for none."""
    inner = F.btrim(lower_ascii(col), F.lit(WORD_SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WORD_SPLIT))


def ngram_rows(df: DataFrame, words: str, n: int, keep: list[str]) -> DataFrame:
    """One row per n-gram of the array column ``words``: the ``keep`` columns and w0 .. w(n-1).

    ``inline`` over zipped slices stays inside generated code, unlike a lambda per position.
    """
    count = F.size(words) - (n - 1)
    zipped = F.arrays_zip(*[F.slice(words, k + 1, count).alias(f"w{k}") for k in range(n)])
    named = zipped.cast("array<struct<" + ",".join(f"w{k}:string" for k in range(n)) + ">>")
    return df.where(F.size(words) >= n).select(*keep, F.inline(named))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage, survives lost executors.

    While it is written, rows go to Python in batches of at most ``ARROW_ROWS``: whole texts are long rows, and a
    batch is held outside the heap on both sides.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(ARROW_BATCH)
    spark.conf.set(ARROW_BATCH, str(min(int(before), ARROW_ROWS) if int(before) > 0 else ARROW_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(ARROW_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if it has at most ``rows`` rows, else as it is (shuffle join)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def anti_rows(docs: DataFrame, key: Column, drop: DataFrame, drop_key: str) -> DataFrame:
    """Rows of ``docs`` whose key is not among the (written) ``drop`` keys; all columns of ``docs``, null keys kept."""
    d = small(drop)
    return docs.join(d, key.eqNullSafe(d[drop_key]), "left_anti")


def fold(id_col: Column, k: int) -> Column:
    """crc32 of the id as text, modulo ``k``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(k))


def hash_sample(df: DataFrame, id_col: str, rows: int, total: int) -> DataFrame:
    """About ``rows`` of ``total`` rows, chosen by a hash of the id: the same rows on every run."""
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1_000_000)) < int(1e6 * rows / total))


def labelled(labels: DataFrame, label: str, id_col: str = "doc_id", folds: int = 5) -> DataFrame:
    """(doc_id, y) of the labelled rows outside the held-out fold; of several labels of one id the largest counts."""
    return (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & (fold(F.col(id_col), folds) != 0))
            .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y")))
