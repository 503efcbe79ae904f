"""Change envelopes: ``payload{before, after, op, ts_ms}`` as JSON text in a binary value.

Build (for tests and derived feeds) and parse (for sources) are both plain
column expressions evaluated in the JVM (``from_json`` / ``to_json`` are
interpreted inside their stage rather than code-generated); no Python runs on
the data path.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdc_lake.functions.timecols import ns_to_ts

# Change operation codes.
OP_CREATE, OP_UPDATE, OP_DELETE, OP_READ = "c", "u", "d", "r"
OPS = (OP_CREATE, OP_UPDATE, OP_DELETE, OP_READ)

# Dead-letter reasons.
NULL_VALUE, UNPARSABLE, BAD_OP, NO_KEY, BAD_DECIMAL = "null_value", "unparsable", "bad_op", "no_key", "bad_decimal"
# How DECIMAL columns arrive: as JSON numbers, or as base64 of the unscaled value.
NUMBER, BASE64 = "number", "base64"


def decimal_columns(row_schema: T.StructType) -> dict[str, T.DecimalType]:
    return {f.name: f.dataType for f in row_schema.fields if isinstance(f.dataType, T.DecimalType)}


def wire_schema(row_schema: T.StructType) -> T.StructType:
    """A row image as it is parsed: DECIMAL columns as text, whatever their encoding, so that
    a value that cannot be decoded is seen instead of turning into null."""
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DecimalType) else f.dataType)
                         for f in row_schema.fields])


def envelope_schema(row_schema: T.StructType, with_before: bool = True) -> T.StructType:
    """Schema of a parsed message: ``payload`` holding before/after images, op and ts_ms.

    Leaving ``before`` out narrows what ``from_json`` materialises; Catalyst does
    not prune fields inside ``from_json`` by itself.
    """
    fields = []
    if with_before:
        fields.append(T.StructField("before", row_schema))
    fields += [
        T.StructField("after", row_schema),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
    return T.StructType([T.StructField("payload", T.StructType(fields))])


def build_value(row_cols: list[str], op: str = "op", ts_ms: str = "ts_ms") -> Column:
    """Envelope JSON for each row: ``before`` absent on create, ``after`` absent on delete."""
    image = F.struct(*[F.col(c) for c in row_cols])
    o = F.col(op)
    payload = F.struct(
        F.when(o != OP_CREATE, image).alias("before"),
        F.when(o != OP_DELETE, image).alias("after"),
        o.alias("op"),
        F.col(ts_ms).alias("ts_ms"),
    )
    return F.to_json(F.struct(payload.alias("payload"))).cast("binary")


def parse_messages(messages: DataFrame, row_schema: T.StructType, with_before: bool = True,
                   keep: tuple[str, ...] = ("topic", "partition", "offset")) -> DataFrame:
    """Decode ``value`` and expand the payload; malformed text, tombstones and
    messages without ``payload`` all give a null ``op``.

    The parsed row is produced by a one-element ``inline(array(...))``: filters
    on the parsed fields then stay above the generator instead of being pushed
    below it, where Catalyst would inline ``from_json`` into the filter
    condition once per field reference and parse every message several times.
    """
    text = F.col("value").cast("string")
    msg = F.from_json(text, envelope_schema(wire_schema(row_schema), with_before))
    kept = [k for k in keep if k in messages.columns]
    row = F.struct(*[F.col(k) for k in kept], F.col("value").isNull().alias("_null_value"),
                   text.alias("_text"), msg.alias("_m"))
    out = messages.select(F.inline(F.array(row)))
    sel = [F.col(k) for k in kept]
    if with_before:
        sel.append(F.col("_m.payload.before").alias("before"))
    sel += [F.col("_m.payload.after").alias("after"), F.col("_m.payload.op").alias("op"),
            F.col("_m.payload.ts_ms").alias("ts_ms"), "_null_value", "_text"]
    return out.select(*sel)


def change_key(pk: str, legacy_null_key: bool = False, has_before: bool = True) -> Column:
    """Key of a change: after-image key, else before-image key.

    ``legacy_null_key`` reproduces the reference, which keys on the after image
    only, so every delete of a batch shares the null key.  Without a parsed
    ``before`` image the after-image key is all there is.
    """
    if legacy_null_key or not has_before:
        return F.col(f"after.{pk}")
    return F.coalesce(F.col(f"after.{pk}"), F.col(f"before.{pk}"))


def decoded_decimal(name: str, kind: T.DecimalType, encoding: str, image: str = "after") -> Column:
    """A DECIMAL column of an image from its parsed text; null when the text is no such value."""
    text = F.col(f"{image}.{name}")
    if encoding == BASE64:
        value = F.when(text.rlike("^[A-Za-z0-9+/]+={0,2}$") & (F.length(text) % 4 == 0) & (F.length(text) <= 12),
                       decode_decimal_b64(text, kind.precision, kind.scale))
        return value
    return text.try_cast(kind)


def dead_letter_reason(pk: str, legacy_null_key: bool = False, has_before: bool = True,
                       decimals: dict[str, T.DecimalType] | None = None, encoding: str = NUMBER) -> Column:
    """Why a parsed message cannot enter the change log (null when it can)."""
    lost = F.lit(False)
    for name, kind in (decimals or {}).items():
        lost = lost | (F.col(f"after.{name}").isNotNull() & decoded_decimal(name, kind, encoding).isNull())
    return (
        F.when(F.col("_null_value"), F.lit(NULL_VALUE))
        .when(F.col("op").isNull(), F.lit(UNPARSABLE))
        .when(~F.col("op").isin(*OPS), F.lit(BAD_OP))
        .when(change_key(pk, legacy_null_key, has_before).isNull(), F.lit(NO_KEY))
        .when(lost, F.lit(BAD_DECIMAL))
    )


def to_change_log(parsed: DataFrame, pk: str, row_cols: list[str], seq: str = "offset",
                  legacy_null_key: bool = False, ns_timestamps: tuple[str, ...] = (),
                  decimals: dict[str, T.DecimalType] | None = None, encoding: str = NUMBER,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Valid messages as change-log rows: key, seq, ts_ms, op, after-image columns, and the
    ``keep`` columns of the message.  ``decimals`` (name to type) are decoded from their text.

    Columns named in ``ns_timestamps`` (DATETIME2 sent as epoch nanoseconds)
    become ``TIMESTAMP_NTZ`` exactly, in the current-state path as well as in
    the history path.
    """
    hb = "before" in parsed.columns
    valid = parsed.where(dead_letter_reason(pk, legacy_null_key, hb, decimals, encoding).isNull())

    def image(c: str) -> Column:
        if c in (decimals or {}):
            return decoded_decimal(c, decimals[c], encoding).alias(c)
        v = F.col(f"after.{c}")
        return (ns_to_ts(v) if c in ns_timestamps else v).alias(c)

    return valid.select(
        change_key(pk, legacy_null_key, hb).alias(pk),
        F.col(seq).alias("seq"),
        "ts_ms",
        "op",
        *[image(c) for c in row_cols if c != pk],
        *keep,
    )


def dead_letters(parsed: DataFrame, pk: str, keep: tuple[str, ...] = ("topic", "offset"),
                 legacy_null_key: bool = False, decimals: dict[str, T.DecimalType] | None = None,
                 encoding: str = NUMBER) -> DataFrame:
    """Messages the change log rejects, with the reason and the raw text."""
    reason = dead_letter_reason(pk, legacy_null_key, "before" in parsed.columns, decimals, encoding)
    return parsed.where(reason.isNotNull()).select(
        *[k for k in keep if k in parsed.columns], reason.alias("reason"), F.col("_text").alias("raw"))


# ---------------------------------------------------------------- decimals
def decode_decimal_b64(b64, precision: int = 18, scale: int = 2) -> Column:
    """The usual CDC-connector DECIMAL encoding: base64 of a big-endian two's complement
    unscaled integer.  Values up to 8 bytes (precision <= 18) decode exactly with
    built-ins: sign-extend the hex to 16 digits, read it as a signed 64-bit number.
    """
    c = F.col(b64) if isinstance(b64, str) else b64
    h = F.hex(F.unbase64(c))
    negative = F.substring(h, 1, 1) >= F.lit("8")
    padded = F.when(negative, F.lpad(h, 16, "F")).otherwise(F.lpad(h, 16, "0"))
    unscaled = F.conv(padded, 16, -10).cast(f"decimal({precision},0)")
    unit = F.lit(Decimal(1).scaleb(-scale))
    return (unscaled * unit).cast(f"decimal({precision},{scale})")


def encode_decimal_b64(d, scale: int = 2) -> Column:
    """Inverse of :func:`decode_decimal_b64`: minimal two's complement bytes, base64."""
    c = F.col(d) if isinstance(d, str) else d
    unscaled = (c * F.lit(10 ** scale)).cast("long")
    h = F.hex(unscaled)
    even = F.when(F.length(h) % 2 == 1, F.concat(F.lit("0"), h)).otherwise(h)
    pos = F.when(F.substring(even, 1, 1) >= F.lit("8"), F.concat(F.lit("00"), even)).otherwise(even)
    neg = F.regexp_replace(h, r"^(FF)+(?=[89A-F])", "")
    return F.base64(F.unhex(F.when(unscaled < 0, neg).otherwise(pos)))
