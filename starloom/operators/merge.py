"""Upserts as DataFrame rewrites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import as_names, row_bytes
from starloom.sources.staging import no_shuffle_left

BROADCAST_SOURCE_ROWS = 200_000  # changes that may be sent to every executor
BROADCAST_SOURCE_BYTES = 128 << 20  # and their size


class MergeConflict(Exception):
    """Several source rows match the same target row."""


def _all(conditions):
    return reduce(lambda a, b: a & b, conditions)


def ambiguous_keys(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Keys that several source rows share and that exist in the target."""
    keys = as_names(keys)
    repeated = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    return repeated.join(target.select(*keys).distinct(), keys, "left_semi")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys,
    update_cols=None,
    insert_cols=None,
    guard: Column | None = None,
    check: bool = True,
    method: str = "auto",
) -> DataFrame:
    """The target after ``WHEN MATCHED UPDATE update_cols, WHEN NOT MATCHED INSERT insert_cols``.

    ``update_cols`` defaults to all columns but the keys, ``insert_cols`` to
    all.  Rows whose key is NULL match nothing; target rows without a match
    survive.  ``guard`` is a condition on ``target.*`` / ``source.*`` that a
    match must also meet to be updated.  Repeated source keys that match raise
    ``MergeConflict``.

    ``auto`` and ``broadcast`` measure the source, which is read two or three times,
    so stage it first if it is costly.  A small one is broadcast: the target is then
    only scanned, never shuffled.  A larger one takes a full outer join (the method
    ``outer``), with NULL keys kept out so they cannot pile up in one partition.
    """
    keys = as_names(keys)
    columns = target.columns
    if set(columns) != set(source.columns):
        raise ValueError("source and target columns differ")
    update = [c for c in columns if c not in keys] if update_cols is None else as_names(update_cols)
    insert = columns if insert_cols is None else as_names(insert_cols)
    source = source.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in columns])

    keyed = _all([F.col(k).isNotNull() for k in keys])
    if check or method in ("auto", "broadcast"):
        # One pass over the source gives its size and whether any key repeats.
        size = row_bytes(source, columns)
        per_key = source.where(keyed).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(size).alias("_bytes"))
        with no_shuffle_left(source.sparkSession):
            rows, volume, most = [v or 0 for v in per_key.agg(F.sum("_n"), F.sum("_bytes"), F.max("_n")).first()]
        if check and most > 1 and not ambiguous_keys(target, source.where(keyed), keys).isEmpty():
            raise MergeConflict(f"several source rows match one target row on {keys}")
        if method in ("auto", "broadcast"):
            small = rows <= BROADCAST_SOURCE_ROWS and volume <= BROADCAST_SOURCE_BYTES
            method = "broadcast" if small else "outer"

    def inserted(rows: DataFrame) -> DataFrame:
        return rows.select(
            *[(F.col(c) if c in insert else F.lit(None).cast(target.schema[c].dataType)).alias(c) for c in columns]
        )

    t, s = target.alias("target"), source.where(keyed).alias("source")
    same = _all([F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys])
    ok = F.lit(True) if guard is None else F.coalesce(guard, F.lit(False))
    keyless = inserted(source.where(~keyed))

    def updated(hit: Column) -> list[Column]:
        take = hit & ok
        return [
            (F.when(take, F.col(f"source.{c}")).otherwise(F.col(f"target.{c}")) if c in update else F.col(f"target.{c}"))
            .alias(c)
            for c in columns
        ]

    if method == "broadcast":
        marked = F.broadcast(source.where(keyed).withColumn("_hit", F.lit(True)).alias("source"))
        kept = t.join(marked, same, "left").select(*updated(F.col("_hit").isNotNull()))
        matched = target.select(*keys).join(F.broadcast(source.where(keyed).select(*keys)), keys, "left_semi").distinct()
        new = inserted(source.where(keyed).join(matched, keys, "left_anti"))
        return kept.unionByName(new).unionByName(keyless)

    old_null = target.where(~keyed)
    both = (
        target.where(keyed)
        .withColumn("_old", F.lit(True))
        .alias("target")
        .join(source.where(keyed).withColumn("_new", F.lit(True)).alias("source"), same, "full_outer")
    )
    hit = F.col("_new").isNotNull()
    changed = []
    for c, column in zip(columns, updated(hit)):
        fresh = F.col(f"source.{c}") if c in insert else F.lit(None).cast(target.schema[c].dataType)
        changed.append(F.when(F.col("_old").isNull(), fresh).otherwise(column).alias(c))
    return both.select(*changed).unionByName(old_null).unionByName(keyless)


def merge_all(target: DataFrame, source: DataFrame, keys, **options) -> DataFrame:
    """Upsert of a regular table: every column, the load stamp too, takes the new value."""
    return merge_upsert(target, source, keys, update_cols=target.columns, **options)


def merge_keep_stamp(
    target: DataFrame, source: DataFrame, keys, stamp_col: str = "LoadDatetime", **options
) -> DataFrame:
    """Upsert of a temporal table: a known version keeps the load stamp it first got."""
    return merge_upsert(target, source, keys, [c for c in target.columns if c != stamp_col], **options)


def fact_merge(target: DataFrame, source: DataFrame, keys, key: str, rekey: bool = False, **options) -> DataFrame:
    """Upsert of a fact.  A known row keeps its surrogate key unless ``rekey``."""
    keep = {*as_names(keys)} | (set() if rekey else {key})
    return merge_upsert(target, source, keys, [c for c in target.columns if c not in keep], **options)
