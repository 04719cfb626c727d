"""Column helpers shared by the operators.  All of them are built-in expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def pairs(on) -> list[tuple[str, str]]:
    """Join keys as (left name, right name); a plain name stands for both sides."""
    on = [on] if isinstance(on, str) else list(on)
    return [(k, k) if isinstance(k, str) else tuple(k) for k in on]


def literal_like(df: DataFrame, column: str, value) -> Column:
    """``value`` as a literal of the type of ``df[column]``.

    Validity columns may be ``timestamp`` or ``timestamp_ntz``; a sentinel has
    to take the same type or the comparison would go through the session zone.
    A local time is passed as text: as a Python value it would be zoned by the
    driver's process.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType) and isinstance(value, dt.datetime):
        value = value.replace(tzinfo=None).isoformat(" ")
    return F.lit(value).cast(kind)


def not_null(column: Column, dtype: T.DataType) -> Column:
    """Declare a column that is never null as such (nullability is part of the contract)."""
    zero = "" if isinstance(dtype, T.StringType) else False if isinstance(dtype, T.BooleanType) else 0
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        zero = "1970-01-01"
    if isinstance(dtype, T.BinaryType):
        zero = b""
    return F.coalesce(column, F.lit(zero).cast(dtype))


def row_bytes(df: DataFrame, columns) -> Column:
    """Rough size of ``columns`` in a row: the length of texts, 16 bytes for anything else."""
    size = F.lit(0).cast("bigint")
    for name in columns:
        texts = isinstance(df.schema[name].dataType, (T.StringType, T.BinaryType))
        size = size + (F.coalesce(F.octet_length(name), F.lit(0)) if texts else F.lit(16))
    return size


def wkt_point(column: Column) -> tuple[Column, Column]:
    """(longitude, latitude) of a ``POINT (lon lat)`` text; NULL where it is not one."""
    parts = F.split(F.regexp_replace(column, r"[()]", ""), " ")
    lon, lat = F.get(parts, F.lit(1)), F.get(parts, F.lit(2))
    return lon.try_cast("double"), lat.try_cast("double")


def epoch_millis(column: Column) -> Column:
    """Epoch milliseconds as a timestamp, milliseconds kept."""
    return F.timestamp_millis(column)


def epoch_days(column: Column) -> Column:
    return F.date_from_unix_date(column)


def fiscal_month(day: Column) -> Column:
    """The fiscal year starts on 1 November."""
    return F.when(F.month(day) >= 11, F.month(day) - 10).otherwise(F.month(day) + 2)


def fiscal_year(day: Column) -> Column:
    return F.when(F.month(day) >= 11, F.year(day) + 1).otherwise(F.year(day))
