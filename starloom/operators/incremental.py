"""Watermarks and load windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.constants import DEFAULT_SINCE
from starloom.functions import literal_like

LOAD = "LoadDatetime"


class MissingLoadColumn(Exception):
    """The table has no load-time column to filter on."""


def high_water_mark(df: DataFrame, column: str = LOAD):
    """Largest ``column`` as a driver value, ``None`` for an empty table."""
    return df.agg(F.max(column)).first()[0]


def between(df: DataFrame, column: str, since, to) -> Column:
    """``since < column <= to``; a missing bound does not restrict."""
    condition = F.lit(True)
    if since is not None:
        condition = condition & (F.col(column) > literal_like(df, column, since))
    if to is not None:
        condition = condition & (F.col(column) <= literal_like(df, column, to))
    return condition


def window_filter(df: DataFrame, column: str = "LastEditedWhen", since=None, to=None) -> DataFrame:
    """Rows changed in ``(since, to]``; pushed down into the source by Catalyst."""
    return df.where(between(df, column, since, to))


def load_filter(df: DataFrame, since, to, column: str = LOAD) -> DataFrame:
    """Rows loaded in ``(since, to]``."""
    if column not in df.columns:
        raise MissingLoadColumn(column)
    return window_filter(df, column, since, to)


def as_of_load(df: DataFrame, to, column: str = LOAD) -> DataFrame:
    """Rows loaded up to ``to``; everything when ``to`` is not given."""
    return df if to is None else load_filter(df, None, to, column)


def fact_window(df: DataFrame, since, to, column: str = LOAD) -> DataFrame:
    """The window of a fact's header table; it takes both bounds to restrict."""
    return load_filter(df, since, to, column) if since is not None and to is not None else df


def temporal_union(
    current: DataFrame,
    archive: DataFrame,
    since=None,
    to=None,
    valid_from: str = "ValidFrom",
    valid_to: str = "ValidTo",
) -> DataFrame:
    """Versions of a temporal table from its current and archive parts.

    First load (``since`` is ``None``): everything started or ended by ``to``,
    kept as a bag.  Later loads: started in the window, or an archived version
    ended in it, as a set.
    """
    if to is not None or since is not None:
        current = current.where(between(current, valid_from, since, to))
        archive = archive.where(between(archive, valid_to, since, to) | between(archive, valid_from, since, to))
    both = current.unionByName(archive)
    return both if since is None and to is not None else both.distinct()


def stamp(df: DataFrame, load_time, column: str = LOAD) -> DataFrame:
    """Add the logical load time."""
    return df.withColumn(column, F.lit(load_time).cast("timestamp"))


def since_of(column: str | Column, default=DEFAULT_SINCE) -> Column:
    """Aggregate: the newest value of a load-time column, or ``default`` for none."""
    newest = F.max(column)
    return F.coalesce(newest, F.lit(str(default)).cast("timestamp_ntz"))


def next_key(column: str | Column) -> Column:
    """Aggregate: the first free key behind the largest one, 1 for none."""
    return F.coalesce(F.max(column), F.lit(0)) + 1


def since_date(target: DataFrame | None, column: str = "RawDataLoadDatetime"):
    """Where the next fact load begins: the newest load seen, or 1900 for none."""
    newest = None if target is None else high_water_mark(target, column)
    return DEFAULT_SINCE if newest is None else newest


def key_offset(target: DataFrame | None, key: str) -> int:
    """First free key: 0 for a missing table, 1 for an empty one, else the largest key + 1."""
    if target is None:
        return 0
    return target.agg(next_key(key)).first()[0]
