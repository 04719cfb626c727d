"""Keep one row per key, always the same one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import as_names
from starloom.operators.hot import HOT_ROWS, attach_per_key


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _kept(columns, keys) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns if c not in keys] or [F.lit(0)])


def dedup_by(df: DataFrame, keys, order_by=()) -> DataFrame:
    """One row per ``keys``: the first by ``order_by``, then by the row's contents.

    ``row_number() = 1`` is planned with a group limit *before* the shuffle, so
    a key with very many rows sends one row per task, not all of them.
    """
    keys = as_names(keys)
    order = [_column(c) for c in ([order_by] if isinstance(order_by, (str, Column)) else order_by)]
    window = Window.partitionBy(*keys).orderBy(*order, _kept(df.columns, keys))
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys, newest_by) -> DataFrame:
    """The newest row per key; ``newest_by`` lists columns, the first one leading."""
    return dedup_by(df, keys, [F.col(c).desc_nulls_last() for c in as_names(newest_by)])


def keep_max_rows(df: DataFrame, keys, column: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All rows that hold the largest ``column`` of their group.

    The maximum is aggregated first (map-side), then attached to the rows, so a
    large group is neither sorted nor shuffled into one task.
    """
    keys = as_names(keys)
    groups = [F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)]
    best = df.groupBy(*groups).agg(F.max(column).alias("_best"), F.count(F.lit(1)).alias("_rows"))
    joined = attach_per_key(df, best, [(k, f"_g{i}") for i, k in enumerate(keys)], "_rows", "inner", hot_rows)
    return joined.where(F.col(column) == F.col("_best")).select(*df.columns)
