"""Tolerant typing of source columns, and date arithmetic.

Spark 4 runs with ANSI mode on: ``cast``/``to_date`` raise on malformed text.
Source data is dirty, so every re-typing here is a ``try_`` variant that
yields NULL instead (the non-ANSI behaviour the source pipeline relied on).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def _type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def as_date(df: DataFrame, name: str) -> Column:
    """Column ``name`` as DATE; unparsable text -> NULL."""
    dtype = _type_of(df, name)
    col = F.col(name)
    if isinstance(dtype, T.DateType):
        return col
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(col)
    return F.try_to_date(col.cast("string"))


# A time of day followed by an explicit zone offset at the end of the text.
_OFFSET_SUFFIX = r"(?i)\d{1,2}:\d{2}(:\d{2}(\.\d*)?)?\s*(z|utc|gmt|[+-]\d{1,2}(:?\d{2})?)$"

# What the last six characters of such a text must hold; far cheaper to look for.
_OFFSET_SIGN = r"[-+A-Za-z]"


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Column ``name`` as TIMESTAMP_NTZ (session-zone wall clock).

    Plain text is taken as wall clock directly, so no session zone (or its
    daylight-saving gaps) can shift it. Text ending in an explicit offset is
    read as an instant and shown in the session zone.
    """
    dtype = _type_of(df, name)
    col = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        return col
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return col.cast("timestamp_ntz")
    text = F.trim(col.cast("string"))
    zoned = F.substring(text, -6, 6).rlike(_OFFSET_SIGN) & text.rlike(_OFFSET_SUFFIX)
    return F.when(
        zoned, F.try_to_timestamp(text).cast("timestamp_ntz")
    ).otherwise(text.try_cast("timestamp_ntz"))


def as_decimal(df: DataFrame, name: str, precision: int, scale: int) -> Column:
    """Column ``name`` as DECIMAL(p, s); bad text or overflow -> NULL."""
    return F.col(name).try_cast(T.DecimalType(precision, scale))


def as_string(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string")


def year_age(later: Column, earlier: Column) -> Column:
    """Calendar-year difference (ignores month and day), as the source does."""
    return F.year(later) - F.year(earlier)


def stay_days(stop: Column, start: Column) -> Column:
    """Whole calendar days from start to stop; negative allowed; NULL-safe."""
    return F.datediff(stop, start)
