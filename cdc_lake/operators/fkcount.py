"""Counted view of foreign-key orphans, maintained from changes of children and parents.

Per ``(fk_name, key)`` the view keeps how many child rows refer to the key and how
many parent rows have it.  A key is orphaned while it has children and no
parent.  Counts add up, so inserts and deletes on either side are signed rows:
a batch of changes is summed to one row per key (map-side combined) and only
those keys' counts are looked at; a deleted parent orphans all its children
without reading them, and a late parent clears them.  Null keys pass, as in
:func:`quality.fk_orphans`, whose result the view equals after any sequence of
changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdc_lake.operators.quality import union_all

KEYS = ("fk_name", "key")
COUNTS = ("children", "parents")


def _signed(tables: dict[str, DataFrame], fks, sign: int) -> list[DataFrame]:
    """One row per foreign key a row takes part in; every table is read once, whatever number of keys it has."""
    by: dict[str, list[Column]] = {}
    for fk in fks:
        for table, col, n in ((fk.child, fk.child_col, (sign, 0)), (fk.parent, fk.parent_col, (0, sign))):
            if table in tables:
                by.setdefault(table, []).append(F.struct(
                    F.lit(fk.name).alias("fk_name"), F.col(col).cast("long").alias("key"),
                    *[F.lit(x).cast("long").alias(c) for c, x in zip(COUNTS, n)]))
    return [tables[t].select(F.inline(F.array(*rows))) for t, rows in by.items()]


def _summed(rows: DataFrame) -> DataFrame:
    sums = rows.where(F.col("key").isNotNull()).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in COUNTS])
    return sums.where(" OR ".join(f"{c} <> 0" for c in COUNTS))


def fk_deltas(inserted: dict[str, DataFrame], deleted: dict[str, DataFrame], fks) -> DataFrame:
    """(fk_name, key, children, parents): what rows inserted into and deleted from the tables change.  An update is a
    delete of the old row and an insert of the new one."""
    return _summed(union_all(_signed(inserted, list(fks), 1) + _signed(deleted, list(fks), -1)))


def fk_counts(tables: dict[str, DataFrame], fks) -> DataFrame:
    """The counts of whole tables."""
    return fk_deltas(tables, {}, fks)


def fk_apply(counts: DataFrame, deltas: DataFrame) -> DataFrame:
    """The counts after ``deltas``: those of untouched keys pass an anti join, touched ones are summed."""
    touched = deltas.select(*KEYS)
    own = counts.join(touched, list(KEYS), "left_semi").select(*KEYS, *COUNTS)
    return counts.select(*KEYS, *COUNTS).join(touched, list(KEYS), "left_anti").unionByName(
        _summed(own.unionByName(deltas.select(*KEYS, *COUNTS))))


def orphaned() -> Column:
    """Rows that refer to the key while it is orphaned, else 0."""
    return F.when((F.col("parents") <= 0) & (F.col("children") > 0), F.col("children")).otherwise(F.lit(0).cast("long"))


def fk_orphans_of(counts: DataFrame) -> DataFrame:
    """(fk_name, child_key, n_rows) of the orphaned keys."""
    return counts.select("fk_name", F.col("key").alias("child_key"), orphaned().alias("n_rows")).where("n_rows > 0")


def fk_orphan_changes(own: DataFrame, deltas: DataFrame) -> DataFrame:
    """(fk_name, key, n_rows): by how much the orphans of the touched keys change; ``own`` holds their old counts."""
    old = own.select(*KEYS, *COUNTS, orphaned().alias("n_rows"))
    new = _summed(own.select(*KEYS, *COUNTS).unionByName(deltas.select(*KEYS, *COUNTS))).select(*KEYS, orphaned().alias("n_rows"))
    return new.unionByName(old.select(*KEYS, (-F.col("n_rows")).alias("n_rows"))).groupBy(*KEYS).agg(
        F.sum("n_rows").alias("n_rows")).where("n_rows <> 0")
