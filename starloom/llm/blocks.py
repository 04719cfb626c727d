"""All pairs inside groups, compared in blocks of bounded size.

A group of any size is cut into blocks by a hash of its items, and every pair
of blocks is a task of its own.  Groups of one block share tasks.  Pairs are
never written out: a task returns, for each item with a partner, its number of
links there and the smallest item it is connected to there.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTIAL = "item long, links long, root long, seen double, expected double"


def compare_groups(
    items: DataFrame, compare: Callable, block_rows: int, bundle_rows: int = 1_000
) -> DataFrame:
    """``PARTIAL`` rows of a written table ``grp, item, weight, ...``.

    ``compare(frame)`` gets at most two blocks and returns a symmetric boolean
    matrix of links and a matrix (or None) of the weights ``1 / p`` by which a
    link that a search finds with probability ``p`` counts, 0 where it missed it.
    """
    sizes = items.groupBy("grp").agg(F.count(F.lit(1)).alias("_n"))
    rows = items.count()
    bundles = max(1, math.ceil(rows / bundle_rows))
    blocks = F.ceil(F.col("_n") / block_rows).cast("int")
    dealt = (
        items.join(sizes.where("_n > 1"), "grp")
        .withColumn("_blocks", blocks)
        .withColumn("_block", F.pmod(F.xxhash64("item", F.lit(17)), F.col("_blocks")).cast("int"))
    )
    # One copy for each other block: a group of m items has (m / block_rows) copies of each.
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        *items.columns,
        "_block",
        (F.col("_blocks") > 1).alias("_large"),
        F.when(F.col("_blocks") > 1, F.col("grp")).otherwise(F.pmod(F.xxhash64("grp"), F.lit(bundles))).alias("_key"),
        F.least("_block", "_other").alias("_i"),
        F.greatest("_block", "_other").alias("_j"),
    )

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        out = [part for _, rows in frame.groupby("grp", sort=False) if len(rows) > 1 and (part := one(rows)) is not None]
        return pd.concat(out) if out else pd.DataFrame([], columns=["item", "links", "root", "seen", "expected"])

    def one(rows: pd.DataFrame) -> pd.DataFrame | None:
        rows = rows.reset_index(drop=True)
        linked, expected = compare(rows)
        if rows["_i"].iat[0] != rows["_j"].iat[0]:  # pairs inside a block belong to the task of that block alone
            block = rows["_block"].to_numpy()
            linked = linked & (block[:, None] != block[None, :])
        np.fill_diagonal(linked, False)
        hit = linked.any(axis=1)
        if not hit.any():
            return None
        item, weight = rows["item"].to_numpy("int64"), rows["weight"].to_numpy("int64")
        root = item.copy()
        while True:
            low = np.minimum(root, np.where(linked, root[None, :], np.iinfo("int64").max).min(axis=1))
            if (low == root).all():
                break
            root = low
        found = linked if expected is None else linked & (expected > 0)
        return pd.DataFrame({
            "item": item,
            "links": linked @ weight,
            "root": root,
            "seen": found.sum(axis=1).astype("float64"),
            "expected": np.where(found, expected, 0.0).sum(axis=1) if expected is not None else 0.0,
        })[hit]

    return dealt.groupBy("_large", "_key", "_i", "_j").applyInPandas(work, PARTIAL)
