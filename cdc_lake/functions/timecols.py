"""Epoch conversions that do not depend on the session time zone.

Change envelopes carry ``ts_ms`` (epoch milliseconds) and row images carry
``DATETIME2`` values as epoch nanoseconds.  All conversions here go through
``TIMESTAMP_NTZ`` arithmetic, so results are the same whatever
``spark.sql.session.timeZone`` is set to.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us_of(ts) -> Column:
    """Epoch microseconds of a ``TIMESTAMP_NTZ`` value.

    Built from the calendar fields (day number, hour, minute, fractional
    second), which Spark reads from an NTZ value without any zone.
    ``timestamp_diff`` would cast to a zoned timestamp and shift by the DST
    offset in non-UTC sessions.
    """
    t = _c(ts)
    days = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return (days * F.lit(86_400_000_000)
            + F.hour(t).cast("long") * F.lit(3_600_000_000)
            + F.minute(t).cast("long") * F.lit(60_000_000)
            + (F.extract(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("long"))


def epoch_ms_of(ts) -> Column:
    """Epoch milliseconds (floored) of a ``TIMESTAMP_NTZ`` value."""
    return floor_div(epoch_us_of(ts), 1000)


def floor_div(x, d: int) -> Column:
    """Exact floor division of a long by a positive constant, in integer arithmetic."""
    v = _c(x).cast("long")
    return F.call_function("div", v - F.pmod(v, F.lit(d).cast("long")), F.lit(d).cast("long"))


def micros_to_ts(us) -> Column:
    """Epoch microseconds -> ``TIMESTAMP_NTZ``."""
    return F.timestamp_add("MICROSECOND", _c(us), F.expr(_EPOCH))


def ms_to_ts(ms) -> Column:
    """Epoch milliseconds -> ``TIMESTAMP_NTZ``."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.expr(_EPOCH))


def ns_to_ts(ns) -> Column:
    """Epoch nanoseconds -> ``TIMESTAMP_NTZ``, floored to the microsecond."""
    return micros_to_ts(floor_div(ns, 1000))


def ns_to_us_double(ns) -> Column:
    """Microseconds the reference gets: ``ns / 1e9`` as a double, cast to a timestamp.

    The cast truncates ``seconds * 1e6``; about one value in ten ends one
    microsecond early.
    """
    return (_c(ns) / F.lit(1_000_000_000) * F.lit(1_000_000)).cast("long")

