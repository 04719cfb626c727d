"""Sizes of written tables, known from the write.

Whether a history can be sent around, whether its versions overlap, and whether
a key may be hot are questions about sizes.  A table that an operator writes
anyway is counted while it is written, and what was found stays with the frame
that is returned; look-ups into it then start no measuring job.  Any further
transformation makes a frame of unknown size again.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from starloom.functions import as_names, row_bytes
from starloom.sources.staging import SMALL, as_written, restore_not_null, stage

VALID = ("ValidFrom", "ValidTo")
TASK_ROWS = 250_000  # rows of a shuffled table that a task takes, where their number is known


class History(NamedTuple):
    """Versions in a history, their bytes, the most real ones of an id, and whether none of an id overlap."""

    rows: int
    bytes: int
    most: int
    disjoint: bool


def known_rows(df: DataFrame) -> int | None:
    """Rows of a frame that ``stage_counted`` or ``stage_history`` returned, or the bound given to ``bounded``."""
    return getattr(df, "_starloom_rows", None)


def bounded(df: DataFrame, rows: int | None) -> DataFrame:
    """``df`` as a frame of ``rows`` rows at most; ``None`` says nothing."""
    if rows is not None:
        df._starloom_rows = rows
    return df


def known_most(df: DataFrame, keys) -> int | None:
    """Rows of one key at most, as ``stage_history`` counted or ``bounded_ids`` was told."""
    return getattr(df, "_starloom_most", {}).get(tuple(as_names(keys)))


def bounded_ids(df: DataFrame, keys, most: int | None) -> DataFrame:
    """``df`` as a frame with ``most`` rows of a key at most; ``None`` says nothing."""
    if most is not None:
        df._starloom_most = {tuple(as_names(keys)): most}
    return df


def spread(df: DataFrame, keys, rows: int | None) -> DataFrame:
    """Shuffle ``df`` by ``keys`` so that a task gets about ``TASK_ROWS`` of its ``rows`` rows at most.

    Where the session's number of shuffle partitions is enough for that, it is taken, and
    Spark may still join small partitions.
    """
    keys, tasks = as_names(keys), math.ceil((rows or 0) / TASK_ROWS)
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(*keys)
    return df.repartition(tasks, *keys)


def stage_counted(df: DataFrame, label: str, keep_not_null: bool = False) -> DataFrame:
    """Write a table, as ``stage`` does, and count its rows meanwhile."""
    seen = Observation()
    staged = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), label, keep_not_null, **SMALL)
    return bounded(staged, seen.get.get("rows"))


def known_history(df: DataFrame, keys, valid: tuple[str, str] = VALID) -> History | None:
    """What was counted for these keys and this interval when the frame was written."""
    return getattr(df, "_starloom_sizes", {}).get((*as_names(keys), *valid))


def stage_history(
    df: DataFrame, label: str, keys, valid: tuple[str, str] = VALID, keep_not_null: bool = False
) -> DataFrame:
    """Write a history, as ``stage`` does, and count it meanwhile.

    The rows are sorted by id and start on the way, which is what a look-up's own
    measurement would do in a job of its own.  A version that ends before or when it
    starts is in force at no time and meets none.
    """
    keys, (start, end) = as_names(keys), valid
    real = F.col(start) < F.col(end)
    versions = Window.partitionBy(*keys, "_real").orderBy(start)
    of_id = Window.partitionBy(*keys).orderBy("_real", start)  # the same sort
    following = F.lead(start).over(versions)
    seen = Observation()
    counted = (
        df.withColumn("_real", F.coalesce(real, F.lit(False)))
        .withColumns(
            {
                "_most": F.when(F.col("_real"), F.row_number().over(versions)),
                "_meets": F.coalesce(F.col("_real") & (following < F.col(end)), F.lit(False)),
                "_each": F.row_number().over(of_id),
                "_size": row_bytes(df, df.columns),
            }
        )
        .observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.sum("_size").alias("bytes"),
            F.max("_most").alias("most"),
            F.max("_meets").alias("meets"),
            F.max("_each").alias("each"),
        )
    )
    staged = stage(counted.select(*df.columns), label, **SMALL)
    if keep_not_null:
        staged = as_written(restore_not_null(staged, df.schema))
    found = seen.get
    if "rows" in found:  # a plan known to be empty may not be observed
        history = History(found["rows"], found["bytes"] or 0, found["most"] or 0, not found["meets"])
        staged._starloom_sizes = {(*keys, *valid): history}
        bounded_ids(bounded(staged, history.rows), keys, found["each"] or 0)
    return staged
