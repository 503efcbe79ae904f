"""Benchmark decontamination: size-partitioned MinHash containment search (operator 2).

A test item of q distinct shingles leaks into a document that holds at least ``threshold`` * q of them, however long
the document is.  Items are partitioned by the power of two of q; every partition has one sketch length k, the number
of shingles that the largest item of the partition may miss, plus one, and each item is represented by its k smallest
shingle hashes (a bottom-k MinHash).  A document that holds enough of the item must hold one of any k of its
shingles, so looking the document's shingles up in the sketches finds every true pair: containment has no false
negatives here, unlike banded signatures, whose recall falls with the ratio of the sizes.  Candidates are then
verified by exact containment of the shingle texts.

The sketches (about a quarter of the items' shingles) are broadcast after their rows were counted; beyond the bound
the shingles are joined by hash with a shuffle.  Only documents with a candidate are read into the second step.

Cases: an item of fewer than five words is searched as one shingle of its own length; an item without words matches
nothing; null texts are empty; null ids are kept.  Every row of the items is an item of its own, also with an id that is
null or repeated, and is reported under its id.  A document is a doc_id with its text: rows that repeat both are one,
texts that share an id are searched one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C


def _hash(n: int):
    return F.xxhash64(*[F.col(f"w{k}") for k in range(n)])


def _shingle(n: int):
    return F.concat_ws(" ", *[F.col(f"w{k}") for k in range(n)])


def item_shingles(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Distinct shingles of the items: item (row number), item_id, n (words per shingle), h, shingle."""
    numbered = C.written(items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).withColumn(
        "item", F.monotonically_increasing_id()), "item-rows")
    words = numbered.select("item", "item_id", C.words_of(C.text_of()).alias("words"))
    out = None
    for n in range(1, width + 1):
        of = words.where(F.size("words") >= n if n == width else F.size("words") == n)
        rows = C.ngram_rows(of, "words", n, ["item", "item_id"]).select(
            "item", "item_id", F.lit(n).alias("n"), _hash(n).alias("h"), _shingle(n).alias("shingle")).distinct()
        out = rows if out is None else out.unionByName(rows)
    return out


def sketches(shingles: DataFrame, threshold: float) -> DataFrame:
    """Bottom-k sketch rows of every item: item, n, h."""
    per = shingles.groupBy("item", "n").agg(F.array_sort(F.collect_set("h")).alias("hs"))
    top = F.pow(F.lit(2.0), F.floor(F.log2(F.size("hs"))) + 1) - 1  # largest item of the partition
    k = (F.floor(top * (1 - threshold) + 1e-9) + 1).cast("int")
    return per.select("item", "n", F.explode(F.slice("hs", F.lit(1), k)).alias("h"))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text", threshold: float = C.SIMILARITY,
          width: int = C.SHINGLE_WORDS) -> DataFrame:
    """Pairs (doc_id, item_id, item_shingles, matched, containment) with containment >= threshold."""
    return _leaks(docs, items, id_col, text_col, item_id_col, item_text_col, threshold, width).drop("text_hash")


def _leaks(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id_col: str = "item_id",
           item_text_col: str = "text", threshold: float = C.SIMILARITY, width: int = C.SHINGLE_WORDS) -> DataFrame:
    """The pairs with the hash that tells texts of one doc_id apart."""
    shingles = C.written(item_shingles(items, item_id_col, item_text_col, width), "items")
    sketch = C.written(sketches(shingles, threshold), "sketches")
    widths = sorted(r["n"] for r in sketch.select("n").distinct().collect())  # at most ``width`` numbers
    doc = ["doc_id", "text_hash"]
    words = docs.select(F.col(id_col).alias("doc_id"), text_hash(text_col).alias("text_hash"),
                        C.words_of(C.text_of(text_col)).alias("words"))

    found = None
    for n in widths:
        own = C.small(sketch.where(F.col("n") == n).select("item", "h"))
        rows = C.ngram_rows(words, "words", n, doc).select(*doc, _hash(n).alias("h")).join(own, "h").select(*doc)
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        found = words.select(*doc).limit(0)
    ids = C.written(found.distinct().select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")), "candidate-docs")
    ids = C.small(ids)
    texts = words.join(ids, (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    sizes = shingles.groupBy("item", "item_id").agg(F.count("*").alias("item_shingles"))
    hits = None
    for n in widths:
        own = C.small(shingles.where(F.col("n") == n).select("item", "shingle"))
        rows = (C.ngram_rows(texts, "words", n, doc).select(*doc, _shingle(n).alias("shingle"))
                .join(own, "shingle").select(*doc, "item", "shingle").distinct())
        hits = rows if hits is None else hits.unionByName(rows)
    if hits is None:
        hits = found.select(*doc, F.lit(0).cast("long").alias("item"))
    matched = hits.groupBy(*doc, "item").agg(F.count("*").alias("matched"))
    return (matched.join(C.small(C.written(sizes, "item-sizes")), "item")
            .where(F.col("matched") >= F.col("item_shingles") * threshold)
            .select("doc_id", "item_id", "item_shingles", "matched",
                    (F.col("matched") / F.col("item_shingles")).alias("containment"), "text_hash"))


def text_hash(text_col: str = "text") -> Column:
    return F.xxhash64(C.text_of(text_col))


def drop_leaking(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) without the documents (doc_id and text) that hold a test item."""
    hit = C.small(C.written(_leaks(docs, items, id_col, text_col).select(
        F.col("doc_id").alias("_drop_id"), F.col("text_hash").alias("_drop_hash")).distinct(), "leaking"))
    return docs.join(hit, docs[id_col].eqNullSafe(hit["_drop_id"]) & (text_hash(text_col) == hit["_drop_hash"]), "left_anti")
