"""Near duplicates among embeddings: random-projection tree forest with spill, verify, union."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.blocks import compare_groups
from starloom.llm.components import connected_components
from starloom.sources.staging import stage

TREES = 10
SPILL = 0.06  # share of a node on either side of its cut that goes both ways
SAMPLE = 20_000  # vectors that the cuts are fitted on, at most
LEAF = 256  # rows that a leaf is planned for
LEAST = 32  # sampled rows that a node needs to be cut at their quantiles
_BAND = NormalDist().inv_cdf(0.5 + SPILL)  # half the band, in deviations, where too few rows are left for quantiles
BLOCK_ROWS = 512


@dataclass
class Tree:
    directions: np.ndarray  # one random direction per level
    cuts: list[dict[int, tuple[float, float]]]  # by level: node -> from where on right, up to where left
    bands: list[dict[int, np.ndarray]]  # by level: node where the cuts end -> its cuts at this and all deeper levels


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that squares stay finite."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def plant(sample: np.ndarray, levels: int, seed: int) -> Tree:
    """Cut a sample recursively at the middle of random projections."""
    directions = np.random.RandomState(seed).normal(size=(max(levels, 1), sample.shape[1]))
    tree = Tree(directions, [], [])
    nodes = {1: np.arange(len(sample))}
    for level in range(levels):
        cuts, bands, below = {}, {}, {}
        for node, rows in nodes.items():
            if len(rows) < LEAST:
                at = sample[rows] @ directions[level:].T
                bands[node] = at.mean(axis=0) + np.outer([-_BAND, _BAND], at.std(axis=0))
                continue
            at = sample[rows] @ directions[level]
            low, high = np.quantile(at, [0.5 - SPILL, 0.5 + SPILL])
            cuts[node] = (float(low), float(high))
            below[2 * node], below[2 * node + 1] = rows[at <= high], rows[at >= low]
        tree.cuts.append(cuts)
        tree.bands.append(bands)
        nodes = below
    return tree


def leaves(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and leaf numbers; a row is in every leaf that its spills lead to.

    Below the nodes that the sample could cut, a node goes on being cut around
    the mean of its sample's projections, so that leaves stay small at any size,
    with a band that would hold the same share of a normal distribution.
    """
    rows, node = np.arange(len(vectors)), np.ones(len(vectors), np.int64)
    ended = np.full(len(vectors), -1)
    kept: list[np.ndarray] = []  # low and high of the ended nodes by level
    for level, direction in enumerate(tree.directions[: len(tree.cuts)]):
        at = (vectors @ direction)[rows]
        low, high = np.zeros(len(rows)), np.zeros(len(rows))
        for name in np.unique(node[ended < 0]):
            here = (ended < 0) & (node == name)
            if name in tree.cuts[level]:
                low[here], high[here] = tree.cuts[level][name]
            else:
                band = np.zeros((2, len(tree.directions)))
                if name in tree.bands[level]:
                    band[:, level:] = tree.bands[level][name]
                kept.append(band)
                ended[here] = len(kept) - 1
        if len(kept):
            own = ended >= 0
            low[own], high[own] = np.stack([b[:, level] for b in kept], axis=1)[:, ended[own]]
        left, right = at <= high, (at >= low) & ~((at == low) & (low == high))
        node = np.concatenate([2 * node[left], 2 * node[right] + 1])
        ended = np.concatenate([ended[left], ended[right]])
        rows = np.concatenate([rows[left], rows[right]])
    return rows, node


def _cosine(threshold: float):
    def compare(rows: pd.DataFrame):
        linked = np.zeros((len(rows), len(rows)), bool)
        dims = rows["vec"].map(len).to_numpy()
        kinds = rows.groupby(["label", dims], sort=False).indices  # a group is named by a hash
        for at in kinds.values():
            vectors = unit(np.stack([np.frombuffer(rows["vec"].iat[k], "<f8") for k in at]))
            linked[np.ix_(at, at)] = np.clip(vectors @ vectors.T, -1, 1) >= threshold
        return linked, None

    return compare


def near_vectors(vectors: DataFrame, threshold: float = 0.93, trees: int = TREES) -> DataFrame:
    """Links between vectors of the same label whose cosine is ``threshold`` or more.

    Equal vectors (same label and components) form a class.  The cuts of the
    trees are fitted on at most ``SAMPLE`` classes, chosen by hash; every class
    goes down every tree.  Classes of one label in a leaf are compared in
    blocks, in double precision, and verified links are united.  Inside each
    component all pairs are then compared once, which counts every link there
    exactly, each once however many leaves it was seen in.

    A vector that is null, empty, zero or has a null or non-finite component, or
    has no label or no id, links with nothing.  Vectors of different length do
    not link.  Repeated rows are copies.  Other columns are ignored.  No
    vectors, no rows.

    Returns ``vec_id, n_links, component_id, kept`` per row.
    """
    numbers = F.col("embedding").cast("array<double>")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), numbers.alias("vec")
    )
    finite = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) <= 1.7976931348623157e308) & ~F.isnan(x))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    key = [F.xxhash64("label", "vec").alias("ka"), F.xxhash64(F.lit("starloom"), "vec", "label").alias("kb")]
    keyed = rows.select("vec_id", "label", "vec", "usable", *key)
    classes = stage(
        keyed.where("usable")
        .groupBy("ka", "kb")
        .agg(
            F.min("vec_id").alias("rep"),
            F.count(F.lit(1)).alias("weight"),
            F.first("label").alias("label"),
            F.first("vec").alias("vec"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    n = classes.count()
    # A bounded sample by hash order.
    taken = classes.select("vec").orderBy(F.xxhash64("vec", F.lit(5)), "node").limit(SAMPLE).collect()
    by_dim: dict[int, list] = {}
    for row in taken:
        by_dim.setdefault(len(row.vec), []).append(row.vec)
    forest = {}
    for dim, sample in by_dim.items():
        share = n * len(sample) / max(len(taken), 1)
        levels = max(0, math.ceil(math.log2(max(share, 1) / LEAF)))
        points = unit(np.array(sample))
        forest[dim] = [plant(points, levels, seed) for seed in range(trees)]
    shared = classes.sparkSession.sparkContext.broadcast(forest)  # at most SAMPLE cuts a level

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = batch["vec"].map(len)
            for dim, part in batch.groupby(size.to_numpy()):
                points = np.stack(part["vec"].to_numpy()).astype(np.float64)
                units = unit(points)
                # A length that the sample lacks has one leaf, compared in blocks.
                paths = [leaves(t, units) for t in shared.value[dim]] if dim in shared.value else [(np.arange(len(part)), np.zeros(len(part), np.int64))]
                packed = np.array([p.astype("<f8").tobytes() for p in points], object)
                for tree, (at, leaf) in enumerate(paths):
                    out = part.iloc[at][["node", "label", "weight"]].reset_index(drop=True)
                    yield out.assign(tree=tree, dim=dim, leaf=leaf, vec=packed[at])

    routed = classes.select("node", "label", "weight", "vec").mapInPandas(
        route, "node long, label string, weight long, tree int, dim int, leaf long, vec binary"
    )
    leafed = routed.select(
        F.xxhash64("tree", "dim", "leaf", "label").alias("grp"), F.col("node").alias("item"), "weight", "label", "vec"
    )
    compared = compare_groups(stage(leafed, "leaves"), _cosine(threshold), BLOCK_ROWS)
    edges = stage(compared.where("item != root").select("item", "root").distinct(), "links")
    roots = connected_components(edges)

    pack = lambda batches: (b.assign(vec=[np.asarray(v, "<f8").tobytes() for v in b["vec"]]) for b in batches)
    members = classes.join(roots.withColumnRenamed("id", "node"), "node").select(
        F.col("root").alias("grp"), F.col("node").alias("item"), "weight", "label", "vec"
    )
    members = stage(members.mapInPandas(pack, "grp long, item long, weight long, label string, vec binary"), "members")
    counted = compare_groups(members, _cosine(threshold), BLOCK_ROWS).groupBy("item").agg(F.sum("links").alias("links"))
    nodes = stage(
        classes.select("node", "ka", "kb", "rep", "weight")
        .join(roots.withColumnRenamed("id", "node"), "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .join(counted.withColumnRenamed("item", "node"), "node", "left"),
        "nodes",
    )
    named = nodes.join(nodes.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select(
        "ka", "kb", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    # Rows that cannot link are kept out of the join.
    linked = keyed.where("usable").select("vec_id", "ka", "kb").join(named, ["ka", "kb"], "left")
    rest = keyed.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (
        linked.select("vec_id", "n_links", "component_id")
        .unionByName(rest)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
