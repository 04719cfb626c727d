"""Dense surrogate keys and unknown members."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import as_names, literal_like, not_null
from starloom.sources.staging import SMALL, stage_parts

_ROW_BITS = 33  # monotonically_increasing_id(): partition number above, row number below
_PART_BITS = 20  # of the partition number; the number of the part above it


def number_rows(
    df: DataFrame, order_by, key: str, offset: int = 0, key_first: bool = True, key_type: str = "int"
) -> DataFrame:
    """Number all rows ``offset, offset + 1, ...`` in the order of ``order_by``.

    Equal to ``row_number() OVER (ORDER BY ...)`` without pulling the table into
    one task.  Rows are range-partitioned and sorted on the whole ordering
    tuple, so one frequent leading value (all versions loaded on the first day,
    say) is split by the columns after it.  The placed rows are written once;
    each file's row count then gives the first number of the next one.  That
    table of starts has one row per partition, which bounds its broadcast.
    Rows equal in ``order_by`` are ordered by a hash of their contents.  Beyond
    two thousand million rows take ``key_type="bigint"``.
    """
    return number_parts([df], order_by, key, offset, key_first, key_type)


def number_parts(
    parts: list[DataFrame],
    order_by,
    key: str,
    offset: int = 0,
    key_first: bool = True,
    key_type: str = "int",
    keep: list[str] | None = None,
) -> DataFrame:
    """As ``number_rows`` for a table in parts, no row of which comes before one of an earlier part.

    The parts are placed one after the other, which takes the disk of one part's shuffles.
    ``keep`` names the columns that are written and returned, by default all.
    """
    columns, keep = parts[0].columns, parts[0].columns if keep is None else keep
    order = [F.col(c) if isinstance(c, str) else c for c in ([order_by] if isinstance(order_by, str) else order_by)]
    order.append(F.xxhash64(*columns))

    def place(df: DataFrame, nth: int) -> DataFrame:
        position = F.monotonically_increasing_id() + F.lit(nth << (_ROW_BITS + _PART_BITS))
        return df.repartitionByRange(*order).sortWithinPartitions(*order).select(*keep, position.alias("_pos"))

    placed = stage_parts((place(df, nth) for nth, df in enumerate(parts)), f"keys-{key}", keep_not_null=True, **SMALL)
    part = F.shiftright("_pos", _ROW_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    row = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    number = F.coalesce((F.col("_start") + row + offset).cast(key_type), F.lit(offset).cast(key_type))
    numbered = placed.join(F.broadcast(starts), part == F.col("_part"), "inner").withColumn(key, number)
    return numbered.select(*([key, *keep] if key_first else [*keep, key]))


def unknown_member(like: DataFrame, values: dict) -> DataFrame:
    """One row shaped like ``like`` holding ``values``; columns not named are NULL."""
    row = []
    for f in like.schema.fields:
        column = literal_like(like, f.name, values.get(f.name))
        row.append((column if f.nullable else not_null(column, f.dataType)).alias(f.name))
    return like.sparkSession.range(1).select(*row)


def with_unknown_member(
    df: DataFrame,
    key: str,
    defaults: dict,
    valid_from,
    valid_to,
    from_col: str = "ValidFrom",
    to_col: str = "ValidTo",
) -> DataFrame:
    """Put the unknown member, always with key 0, in front of the numbered rows."""
    values = {**defaults, key: 0, from_col: valid_from, to_col: valid_to}
    return unknown_member(df, values).unionByName(df)


def dimension_keys(df: DataFrame, order_by, key: str, offset: int, defaults: dict | None, valid_from, valid_to):
    """Keys of a dimension: from 1 after an unknown member on the first load, else from ``offset``."""
    if offset:
        return number_rows(df, as_names(order_by), key, offset)
    numbered = number_rows(df, as_names(order_by), key, 1)
    return with_unknown_member(numbered, key, defaults or {}, valid_from, valid_to)
