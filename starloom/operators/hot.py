"""Splitting of very frequent keys.

Ordered work per key (next version, version in force at a time) is a window
partitioned by the key, which sends one key's rows to one task.  Keys above
``HOT_ROWS`` rows are found first and cut into slices of time that hold about
equally many rows, wherever in time they lie; the operators carry what crosses
a slice border as extra rows.  Without such keys the plan is the plain window.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.sizes import known_most, known_rows, stage_counted
from starloom.sources.staging import stage

HOT_ROWS = 1_000_000  # rows of one key that one task may still take
ATTACH_KEYS = 500_000  # rows of a table with a row per key that may be sent to every executor


def find_hot(df: DataFrame, keys: list[str], at: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The keys with more than ``hot_rows`` rows and ``_cuts``, times that cut their rows evenly; ``None`` if there are none.

    All of them, as a written table that stays on the executors.  One aggregate
    over the key columns of ``df``, and, where a key is hot, two more over its rows;
    stage ``df`` first if it is costly.  A frame written by ``stage_history`` with no
    more rows than that in all, or of an id, is not searched.  Rows of one instant are never
    cut apart.
    """
    if any(known is not None and known <= hot_rows for known in (known_rows(df), known_most(df, keys))):
        return None
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    most = counts.agg(F.max("_rows")).first()[0]
    if most is None or most <= hot_rows:
        return None
    found = stage(counts.where(F.col("_rows") > hot_rows), "hot")
    slices = math.ceil(2 * most / max(hot_rows, 1))
    at_rows = df.select(*keys, F.col(at).alias("_at"))
    steps = [n / slices for n in range(1, slices)] or [0.5]
    cuts = F.array_distinct(F.percentile_approx("_at", steps, max(10_000, 20 * slices)))
    cut = _named(at_rows, found, keys, "left_semi").groupBy(*keys).agg(F.coalesce(cuts, F.array()).alias("_cuts"))
    return stage(cut, "hot-cuts")


def _named(df: DataFrame, hot: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``df`` joined to ``hot``, whose keys are renamed; missing keys match."""
    marked = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], *[c for c in hot.columns if c not in keys])
    # No hint: the table's written size tells Catalyst whether to broadcast it.
    return df.join(marked, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]), how)


def _cuts_up_to(cuts: Column, at: Column) -> Column:
    """How many of the ascending ``cuts`` are not after ``at``: a binary search."""
    powers = F.array(*[F.lit(1 << n) for n in reversed(range(24))])

    def step(below: Column, more: Column) -> Column:
        further = below + more
        # The index stays valid where it is not used.
        reached = F.try_element_at(cuts, further) <= at
        return F.when(F.coalesce((further <= F.size(cuts)) & reached, F.lit(False)), further).otherwise(below)

    return F.aggregate(powers, F.lit(0), step)


def with_slices(df: DataFrame, hot: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Add ``_slice``: the number of the time slice for hot keys, rows without a time first; NULL for all others."""
    number = F.when(F.col(at).isNull(), -1).otherwise(_cuts_up_to(F.col("_cuts"), F.col(at)))
    sliced = _named(df, hot, keys, "left").withColumn("_slice", F.when(F.col("_cuts").isNotNull(), number))
    return sliced.drop("_cuts", *[f"_hot_{k}" for k in keys])


def may_broadcast(per_key: DataFrame) -> bool:
    """Whether a table with a row per key was counted as small when it was written."""
    rows = known_rows(per_key)
    return rows is not None and rows <= ATTACH_KEYS


def attach_per_key(df: DataFrame, per_key: DataFrame, on: list[tuple[str, str]], count: str, how: str = "left", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join ``per_key``, one row per key, to the many rows of ``df``; missing keys match.

    ``on`` pairs key columns of ``df`` with those of ``per_key``, whose column
    ``count`` says how many rows of ``df`` a key has and is left out of the result.  A ``per_key`` counted as small while it is
    written is sent around, so no row of ``df`` moves.  Of a larger one only the
    keys above ``hot_rows`` rows are, which are fewer than the rows of ``df`` by that
    factor; the rows of all others are shuffled by key.  ``how`` is ``left`` or ``inner``.
    """
    if known_rows(per_key) is None:
        per_key = stage_counted(per_key, "per-key")

    def join(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return rows.join(keys, reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in on]), how)

    if may_broadcast(per_key):
        return join(df, F.broadcast(per_key.drop(count)), how)
    frequent = F.col(count) > hot_rows
    hot = F.broadcast(per_key.where(frequent).drop(count))
    names = [b for _, b in on]
    cold = join(join(df, hot.select(*names), "left_anti"), per_key.where(~frequent).drop(count), how)
    return join(df, hot, "inner").unionByName(cold)
