"""Connected components by alternating stars; edges never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.sources.staging import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, root``: the smallest id reachable from every id that an edge (first two columns) names.

    Every round links each vertex's larger neighbours to the smallest one, then
    its smaller neighbours; it ends when no edge changes, after a number of
    rounds that grows with the logarithm of the longest path.  Rounds are
    written to the shared folder, which cuts the lineage.  A vertex with many
    edges is aggregated map-side and its join is dealt anew by adaptive
    execution.  Edges from a vertex to itself, repeated edges and missing ids
    are left out; no edges, no rows.
    """
    a, b = (F.col(c).cast("long") for c in edges.columns[:2])
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    stars = stage(pairs.where(a.isNotNull() & b.isNotNull() & (F.col("u") != F.col("v"))).distinct(), "edges")
    before = _state(stars)
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = stage(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _state(stars)
        if after == before:
            break
        before = after
    roots = stars.select("v").distinct()
    return stars.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("id"), F.col("v").alias("root"))
    )


def _state(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())
