"""Scalar column functions.  All are built-in Spark expressions (codegen'd)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296
U64_MAX = 18446744073709551615
MB = 1048576.0


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def narrow_u32(col) -> Column:
    """Wrapping ``as u32``: the value modulo 2^32 (ANSI ``cast`` would raise)."""
    return F.pmod(_c(col).cast("bigint"), F.lit(TWO_32))


def flag_u8(col) -> Column:
    """Boolean -> 0/1 SMALLINT."""
    return _c(col).cast("smallint")


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds of a TIMESTAMP or TIMESTAMP_NTZ (read as UTC)."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def bucket_start(epoch, seconds: int) -> Column:
    """Start of the hour (3600) / minute (60) bucket of an epoch-seconds value."""
    e = _c(epoch)
    return (e - F.pmod(e, F.lit(seconds))).cast("bigint")


def epoch_to_date(epoch) -> Column:
    return F.to_date(F.timestamp_seconds(_c(epoch)))


def strip_repeated_suffix(col, suffix: str) -> Column:
    """``a.meta.meta`` -> ``a``: remove the suffix as often as it ends the name."""
    return F.regexp_replace(_c(col), "(" + suffix.replace(".", "\\.") + ")+$", "")


def start_slot(prefix) -> Column:
    """First ``_`` token of a prefix as an unsigned 64-bit number; NULL if not one."""
    token = F.split_part(_c(prefix), F.lit("_"), F.lit(1))
    value = F.regexp_replace(token, "^\\+", "").try_cast("decimal(38,0)")
    ok = token.rlike("^\\+?[0-9]+$") & (value <= F.lit(Decimal(U64_MAX)).cast("decimal(38,0)"))
    return F.when(ok, value.cast("decimal(20,0)"))



# Authority level names, matched case-insensitively; others -> 0.
AUTHORITY_LEVELS = {"LV0": 0, "LV1": 1, "LV2": 2, "LV3": 3, "LV4": 4, "LV5": 5}


def authority_level(text) -> Column:
    up = F.upper(_c(text))
    expr = F.lit(0)
    for name, level in reversed(list(AUTHORITY_LEVELS.items())):
        expr = F.when(up == F.lit(name), F.lit(level)).otherwise(expr)
    return expr.cast("int")


# Channel stream name ``telepath_{channel}`` and subject
# ``telepath_{channel}.lv{authority}`` formats.
STREAM_PREFIX = "telepath_"
SUBJECT_LEVEL = ".lv"


def channel_stream(channel) -> Column:
    return F.concat(F.lit(STREAM_PREFIX), _c(channel).cast("string"))


def channel_subject(channel, authority) -> Column:
    """``telepath_{name}.lv{n}``."""
    return F.concat(channel_stream(channel), F.lit(SUBJECT_LEVEL), _c(authority).cast("string"))


def key_from_long(col, width: int = 32) -> Column:
    """Big-endian ``width``-byte key holding a non-negative BIGINT (stand-in keys):
    a constant zero prefix and the 8 value bytes."""
    low = F.unhex(F.lpad(F.hex(_c(col).cast("bigint")), 16, "0"))
    return F.concat(F.lit(bytes(width - 8)), low) if width > 8 else low
