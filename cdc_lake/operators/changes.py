"""Change log -> tables: latest per key, current state (SCD1), version history (SCD2).

A change log is any DataFrame with a key, an ordering (``ts``, ``seq``), an op
code and the after-image columns; ``batch`` columns are optional.  All
operators are pure DataFrame -> DataFrame functions, so the same code serves a
batch over the whole log, one micro-batch in ``foreachBatch``, or a replay.

"Latest per key" is an aggregate, ``max_by(row, (ts, seq))``: it is combined
map-side before the shuffle, so a key holding a third of the rows is reduced to
one row per input partition before anything moves.  Reference-compatible
modes are flags; the defaults give the correct result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdc_lake.functions.envelope import OP_CREATE, OP_DELETE, OP_READ, OP_UPDATE
from cdc_lake.operators.sequence import keyed_next

ORDER = ("ts", "seq")


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest_per_key(log: DataFrame, key, cols: list[str], order=ORDER, by: list[str] = ()) -> DataFrame:
    """Last change of each key (within each ``by`` group): one row per group.

    Ties on the full ordering cannot happen when ``seq`` is unique; without
    ``seq`` the winner of equal ``ts`` is the larger image, deterministically.
    """
    keys = [*_keys(key), *by]
    carry = [c for c in dict.fromkeys([*order, "op", *cols]) if c not in keys]
    win = F.max_by(F.struct(*[F.col(c) for c in carry]),
                   F.struct(*[F.col(o) for o in order]))
    return log.groupBy(*keys).agg(win.alias("_w")).select(*keys, *[F.col("_w." + c).alias(c) for c in carry])


def current_state(log: DataFrame, key, cols: list[str], order=ORDER, apply_deletes: bool = True,
                  order_guard: bool = True, batch: str | None = None) -> DataFrame:
    """SCD type 1: the current row of every key.

    ``apply_deletes=False`` reproduces the reference, which drops delete events
    before the merge, so deleted rows stay.  ``order_guard=False`` lets the
    later micro-batch win whatever its event time (needs ``batch``).
    """
    src = log if apply_deletes else log.where(F.col("op") != OP_DELETE)
    o = list(order) if order_guard else [batch, *order]
    latest = latest_per_key(src, key, cols, o)
    if apply_deletes:
        latest = latest.where(F.col("op") != OP_DELETE)
    return latest


def upsert(snapshot: DataFrame, changes: DataFrame, key, cols: list[str], order=ORDER,
           apply_deletes: bool = True, order_guard: bool = True) -> DataFrame:
    """SCD1 merge of one batch into a snapshot: newer changes replace matched
    rows, new keys are inserted, deleted keys removed.

    The snapshot carries the ``order`` columns, so an older late change loses
    against the row it finds.  If it also carries ``op``, deleted keys stay in
    it as tombstones (op ``d``) and a late change cannot bring them back;
    readers drop them.  ``order_guard=False`` is the plain ``MERGE ... WHEN MATCHED
    UPDATE * WHEN NOT MATCHED INSERT *``: the batch wins whatever its event time.
    """
    keys = _keys(key)
    if not apply_deletes:
        changes = changes.where(F.col("op") != OP_DELETE)
    out_cols = [*keys, *[c for c in snapshot.columns if c not in keys]]
    if order_guard:
        missing = [o for o in order if o not in snapshot.columns]
        if missing:
            raise ValueError(f"the snapshot has no order column {', '.join(missing)}")
        kept = "op" in snapshot.columns
        base = snapshot if kept else snapshot.withColumn("op", F.lit(OP_READ))
        rest = [c for c in snapshot.columns if c not in (*keys, *order, "op")]
        merged = compact(base, changes, key, rest, order)
        return (merged if kept else merged.where(F.col("op") != OP_DELETE)).select(*out_cols)
    last = latest_per_key(changes, key, cols, order)
    kept = snapshot.join(last.select(*keys), keys, "left_anti")
    new = last.where(F.col("op") != OP_DELETE)
    return kept.select(*out_cols).unionByName(new.select(*out_cols))


def compact(base: DataFrame | None, tail: DataFrame, key, cols: list[str], order=ORDER,
            drop_tombstones_before=None) -> DataFrame:
    """New snapshot of the log: last change per key over ``base`` (an older
    snapshot, one row per key, or None) and the log ``tail`` after it.

    Only keys that occur in the tail can change.  The base rows of the other
    keys pass through an anti join with the tail's distinct keys -- when
    those are small enough Spark broadcasts them and the base is not
    shuffled at all; the base rows of touched keys (a semi join) are folded
    with the tail by the per-key aggregate, so the shuffle is the size of
    the change, not of the table.

    Deleted keys stay as tombstones (op ``d``), so a late change that is older
    than the delete cannot bring the key back; readers drop them
    (:func:`current_state` on the snapshot).  ``drop_tombstones_before`` (a value
    of the first ``order`` column) purges tombstones no late event can undo.
    """
    keys = _keys(key)
    carry = [*keys, *[c for c in dict.fromkeys([*order, "op", *cols]) if c not in keys]]
    t = tail.select(*carry)
    if base is None:
        snap = latest_per_key(t, key, cols, order)
    else:
        b = base.select(*carry)
        touched = t.select(*keys).distinct()
        folded = latest_per_key(b.join(touched, keys, "left_semi").unionByName(t), key, cols, order)
        snap = b.join(touched, keys, "left_anti").unionByName(folded.select(*carry))
    if drop_tombstones_before is not None:
        snap = snap.where((F.col("op") != OP_DELETE) | (F.col(order[0]) >= drop_tombstones_before))
    return snap


def touch_updated_at(log: DataFrame, key, cols: list[str], order=ORDER, ts: str = "ts") -> DataFrame:
    """Current state with ``created_at`` from the first image (after the last
    delete, if any) and ``updated_at`` moved by every later change (what the source's update triggers maintain).

    One aggregate folds the log to a summary per key: last delete, first image, last image, number of changes; it is
    combined map-side, one row per task and key.  The first image is the answer for every key that was never deleted,
    and a key whose last change is a delete has no row.  Only keys that were deleted and created again are looked up
    in the log a second time, for the first image after their last delete: a join with those keys' summaries, which
    Spark broadcasts when they are few, filtered before the second (again map-side combined) aggregate.  Keys are
    compared null-safely throughout.
    """
    keys = _keys(key)
    carry = [c for c in dict.fromkeys([*order, "op", *cols]) if c not in keys]
    place = F.struct(*[F.col(o) for o in order])
    gone = F.col("op") == OP_DELETE
    own = F.struct(*keys).alias("_k")  # nulls in a struct are equal: joins on it are null-safe and reuse its partitioning
    agg = log.groupBy(own).agg(
        F.max(F.when(gone, place)).alias("_gone"),
        F.min(F.when(~gone, F.col(ts))).alias("_first"),
        F.max_by(F.struct(*[F.col(c) for c in carry]), place).alias("_w"),
        F.count(F.lit(1)).alias("n_changes"),
    ).where(F.col("_w.op") != OP_DELETE)
    born = agg.where(F.col("_gone").isNotNull()).select("_k", F.col("_gone").alias("_after"))
    later = log.where(~gone).select(own, F.col(ts).alias("_ts"), place.alias("_place"))
    again = later.join(born, "_k").where(F.col("_place") > F.col("_after")).groupBy("_k").agg(F.min("_ts").alias("_again"))
    return agg.join(again, "_k", "left").select(
        *[F.col(f"_k.{k}").alias(k) for k in keys], *[F.col("_w." + c).alias(c) for c in cols if c not in keys],
        F.when(F.col("_gone").isNull(), F.col("_first")).otherwise(F.col("_again")).alias("created_at"),
        F.col("_w." + ts).alias("updated_at"), "n_changes")


def bootstrap_union(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Snapshot rows (op ``r``) first, then the change feed, as one log."""
    snap = snapshot.withColumn("op", F.lit(OP_READ)) if "op" not in snapshot.columns else snapshot
    return snap.unionByName(changes, allowMissingColumns=True)


# ------------------------------------------------------------------ SCD2
def scd2_history(log: DataFrame, key, cols: list[str], order=ORDER, ts: str = "ts",
                 bucket: Column | None = None) -> DataFrame:
    """Full SCD type 2: one version per create/update/read, closed by the next
    change of the key at exactly its event time; deletes close without opening.

    ``bucket`` (monotone in the order, e.g. the hour of ``ts``) splits hot keys
    across tasks; see :mod:`cdc_lake.operators.sequence`.
    """
    keys = _keys(key)
    x = keyed_next(log.select(*keys, *order, "op", *[c for c in cols if c not in (*keys, *order)]),
                   keys, list(order), [ts], bucket)
    return x.where(F.col("op") != OP_DELETE).select(
        *keys, *[c for c in cols if c not in keys],
        F.col(ts).alias("valid_from"), F.col("next_" + ts).alias("valid_to"),
        F.col("next_" + ts).isNull().alias("is_current"),
    )


def scd2_rows(log: DataFrame, key, cols: list[str], order=ORDER, ts: str = "ts", bucket=None) -> DataFrame:
    """The history in the form in which it is stored: one row per change, deletes included, with the ordering
    columns, op and the version's end.  :func:`scd2_versions` gives the history proper."""
    keys = _keys(key)
    own = [*keys, *[c for c in dict.fromkeys([*order, "op", *cols]) if c not in keys]]
    return keyed_next(log.select(*own), keys, list(order), [ts], bucket).select(
        *own, F.col("next_" + ts).alias("valid_to"))


def scd2_versions(rows: DataFrame, key, cols: list[str], ts: str = "ts") -> DataFrame:
    """The versions of stored history rows: deletes close a version and open none."""
    keys = _keys(key)
    return rows.where(F.col("op") != OP_DELETE).select(
        *keys, *[c for c in cols if c not in keys], F.col(ts).alias("valid_from"), "valid_to",
        F.col("valid_to").isNull().alias("is_current"))


def scd2_extend(stored: DataFrame, tail: DataFrame, key: str, cols: list[str], order=ORDER, ts: str = "ts",
                bucket=None) -> DataFrame:
    """Stored history rows brought up to date with the ``tail`` of the log alone.

    The stored rows of keys without new changes pass an anti join.  The others
    are rebuilt from their stored rows, which carry every change of the key,
    and the tail: a late change splits the old version it falls into, and a
    change delivered twice counts once.  Nothing before the tail is read again.
    """
    own = [c for c in stored.columns if c != "valid_to"]
    keys = tail.select(key).distinct()
    redo = stored.join(keys, key, "left_semi").select(*own).unionByName(tail.select(*own)).dropDuplicates(
        [key, *order, "op"])
    return stored.join(keys, key, "left_anti").unionByName(
        scd2_rows(redo, key, cols, order, ts, bucket).select(*stored.columns))


def scd2_refresh(history: DataFrame, log: DataFrame, changed: DataFrame, key: str, cols: list[str],
                 order=ORDER, ts: str = "ts", bucket=None) -> DataFrame:
    """Bring a stored SCD2 ``history`` up to date with the ``changed`` rows of
    the ``log`` (which already holds them): the incremental form of
    expire-then-insert, in event time.

    Only keys that occur in ``changed`` can get new or different versions.
    The stored rows of every other key pass an anti join with the distinct
    changed keys (broadcast by Spark when small: the history is streamed,
    not shuffled).  The history of the changed keys is rebuilt from their log
    rows (a semi join), so a late change that falls between two old versions
    splits them exactly as the full history would.  The shuffle is the size
    of the changed keys' rows, not of the log.
    """
    keys = changed.select(key).distinct()
    kept = history.join(keys, key, "left_anti")
    redo = scd2_history(log.join(keys, key, "left_semi"), key, cols, order, ts, bucket)
    return kept.unionByName(redo.select(*history.columns))


def scd2_collapsed(log: DataFrame, key, cols: list[str], batch: str, order=ORDER) -> DataFrame:
    """SCD2 with one version per key and micro-batch: the batch's last change
    wins, the version runs from its batch to the key's next batch."""
    keys = _keys(key)
    last = latest_per_key(log, key, cols, order, by=[batch])
    # Per key there is at most one row per batch: the window holds #batches rows.
    x = keyed_next(last, keys, [batch], [batch])
    return x.where(F.col("op") != OP_DELETE).select(
        *keys, *[c for c in cols if c not in keys],
        F.col(batch).alias("effective_date"), F.col("next_" + batch).alias("end_date"),
        F.col("next_" + batch).isNull().alias("is_current"),
    )


def scd2_reference(log: DataFrame, key: str, cols: list[str], batch: str, order=ORDER) -> DataFrame:
    """The reference's micro-batch SCD2, reproduced without a loop.

    Per batch: last event per *after-image* key (all deletes share the null key,
    so one delete per batch survives); keys of updates/deletes expire the open
    version; creates/updates open a new one (snapshot reads ``r`` are dropped).
    A version ends at the first later batch that expires its key.
    """
    pkey = F.when(F.col("op") == OP_DELETE, F.lit(None)).otherwise(F.col(key))
    carry = [c for c in dict.fromkeys([key, *order, "op", *cols])]
    s = (log.groupBy(F.col(batch), pkey.alias("_pkey"))
         .agg(F.max_by(F.struct(*[F.col(c) for c in carry]), F.struct(*[F.col(o) for o in order])).alias("_w"))
         .select(batch, *[F.col("_w." + c).alias(c) for c in carry]))
    # One pass over the deduped batch: a create/update opens a version, an
    # update/delete expires the key (an update does both).  Repeated expiry
    # rows cannot change the running minimum below, so no DISTINCT is needed.
    btype = s.schema[batch].dataType
    rest = [c for c in cols if c != key]
    opened = F.when(F.col("op").isin(OP_CREATE, OP_UPDATE), F.struct(
        F.col(key).alias(key), *[F.col(c).alias(c) for c in rest], F.col(batch).alias(batch),
        F.lit(1).alias("_kind"), F.lit(None).cast(btype).alias("_exp")))
    expired = F.when(F.col("op").isin(OP_UPDATE, OP_DELETE), F.struct(
        F.col(key).alias(key), *[F.lit(None).cast(s.schema[c].dataType).alias(c) for c in rest],
        F.col(batch).alias(batch), F.lit(0).alias("_kind"), F.col(batch).alias("_exp")))
    both = s.select(F.inline(F.array_compact(F.array(opened, expired))))
    # Walk each key from its latest batch back; expiries of the same batch sort
    # after the opening, so "earliest expiry seen so far" is the first later one.
    w = (Window.partitionBy(key).orderBy(F.col(batch).desc(), F.col("_kind").desc())
         .rowsBetween(Window.unboundedPreceding, -1))
    end = F.min("_exp").over(w)
    return both.select("*", end.alias("end_date")).where("_kind = 1").select(
        key, *[c for c in cols if c != key], F.col(batch).alias("effective_date"), "end_date",
        F.col("end_date").isNull().alias("is_current"))


def history_head(log: DataFrame, key: str, cols: list[str], n: int = 10, order=ORDER, ts: str = "ts",
                 bucket=None) -> DataFrame:
    """The first ``n`` SCD2 versions by ``(key, valid_from)``, built from the
    history of at most ``n`` keys.

    Every create/update/read opens a version, so the first ``n`` versions
    belong to the ``n`` smallest keys that have a non-delete change.  Those
    keys come from a distinct + ``TakeOrderedAndProject`` (``n`` rows), the
    log is semi-joined to them (null-safe), and only their history is built:
    the window no longer runs over the whole log.
    """
    first = (log.where(F.col("op") != OP_DELETE).select(key).distinct()
             .orderBy(F.col(key).asc_nulls_first()).limit(n).select(F.col(key).alias("_k")))
    sub = log.join(first, log[key].eqNullSafe(first["_k"]), "left_semi")
    return scd2_history(sub, key, cols, order, ts, bucket).orderBy(
        F.col(key).asc_nulls_first(), F.col("valid_from").asc_nulls_first()).limit(n)


def _int_key(key: str, value) -> int:
    """The lookup key as an integer (the reader's argument check)."""
    if isinstance(value, bool) or not isinstance(value, int):
        try:
            value = int(str(value), 10)
        except ValueError:
            raise ValueError(f"{key} must be an integer, got {value!r}") from None
    return value


def history_lookup(history: DataFrame, key: str, value, order: str = "valid_from") -> DataFrame:
    """Versions of one key in time order.  The key must be an integer; the
    filter is a plain equality, pushed down to the scan of a stored history
    (or through the per-key window to the change-log scan)."""
    return history.where(F.col(key) == F.lit(_int_key(key, value))).orderBy(order)


def history_of(log: DataFrame, key: str, value, cols: list[str], order=ORDER, ts: str = "ts",
               bucket=None) -> DataFrame:
    """Versions of one key built from that key's change rows only.

    The history of a key depends on its own rows alone, so the equality
    filter is applied to the log first: it reaches the scan before anything
    runs, including the eager hot-key check of ``bucket`` (which would
    otherwise group the whole log to answer a one-key question).
    """
    v = _int_key(key, value)
    return scd2_history(log.where(F.col(key) == F.lit(v)), key, cols, order, ts, bucket).orderBy("valid_from")

def scd2_expire(history: DataFrame, keys: DataFrame, key: str, at) -> DataFrame:
    """Close the open version of the given keys at ``at`` (matched-update only)."""
    k = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    j = history.join(k, key, "left")
    hit = F.col("_hit").isNotNull() & F.col("is_current")
    at_col = at if isinstance(at, Column) else F.lit(at)
    return j.select(
        *[F.when(hit, at_col.cast(history.schema["end_date"].dataType)).otherwise(F.col("end_date")).alias(c)
          if c == "end_date" else
          (F.when(hit, F.lit(False)).otherwise(F.col("is_current")).alias(c) if c == "is_current" else F.col(c))
          for c in history.columns])
