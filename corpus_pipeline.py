"""A corpus pipeline: toxicity, exact dedup, n-gram Jaccard join, benchmark decontamination, BPE encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's
``docs``; all but the last return the columns of ``documents``.  A stage decides from the documents it is given:

* ``toxicity`` drops the documents predicted toxic (lexicon and weights learned from ``labels``);
* ``exact_dedup`` keeps of equal texts (A-Z lower-cased) the one with the largest doc_id;
* ``ngram_join`` keeps of every group linked by 5-word shingle Jaccard >= 0.75 the one with the smallest doc_id;
* ``decontaminate`` drops the documents that hold at least 0.75 of a benchmark item's shingles;
* ``bpe`` returns doc_id, n_tokens, ids_sha256 and decoded_sha256 of what is left.

Null and empty texts are equal to each other, never toxic, linked or contaminated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cdc_lake.llm import common as C
from cdc_lake.llm.bpe import encode_digest
from cdc_lake.llm.decontaminate import drop_leaking
from cdc_lake.llm.exact_dedup import drop_copies
from cdc_lake.llm.ngram_join import drop_near_copies
from cdc_lake.llm.toxicity import drop_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, C.table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaking(docs, C.table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_digest(docs, C.vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_join", ngram_join),
    ("decontaminate", decontaminate),
    ("bpe", bpe),
]

#: SQL can't express the first stage (a fitted model) and the last (BPE); tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written to the shared folder and read again."""
    df = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        df = C.written(stage(spark, df, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, df, sf_dir)
