"""Jaccard join on word shingles: MinHash LSH forest, then exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.blocks import compare_groups
from starloom.llm.common import word_hash, words_of
from starloom.llm.components import connected_components
from starloom.sources.staging import stage

SHINGLE = 5
TREES, LEVELS = 12, 5  # signature values: one trie of LEVELS values per tree
MARGIN = 5.0  # standard deviations by which a signature may understate a pair's likeness
BLOCK_ROWS = 128
SMALL_NODE = 64  # classes under a node that is compared whole
NODE_ROWS = 512  # signatures of a larger one compared with each other at a time
BUNDLE_ROWS = 20_000  # of small nodes in one call
_COLUMNS = 4_096  # shingles hashed or compared at a time
_MULTIPLIERS = np.random.RandomState(20).randint(1, 2**62, TREES * LEVELS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles_of(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words.

    A text of fewer words has one shingle, all its words; one without words has none.
    """
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    hashes = np.fromiter(map(word_hash, words), np.uint64, len(words))
    runs = len(words) - size + 1
    total = np.full(runs, np.uint64(size))
    for k in range(size):
        total = total * _STEP + hashes[k : k + runs]
        total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    total ^= total >> np.uint64(32)
    return np.unique(total)


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values, one row per tree."""
    low = np.full(len(_MULTIPLIERS), np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), _COLUMNS):
        part = shingles[at : at + _COLUMNS]
        low = np.minimum(low, (part[None, :] * _MULTIPLIERS[:, None]).min(axis=1))
    return (low >> np.uint64(32)).astype(np.uint32).reshape(TREES, LEVELS)


def found_at(depth: int, likeness):
    """Probability that a pair of this Jaccard likeness shares a prefix of ``depth`` in some tree."""
    return 1 - (1 - np.asarray(likeness, float) ** depth) ** TREES


def depths(threshold: float, recall: float) -> list[int]:
    """Prefix lengths to match, the longest first, down to the first that finds a pair at ``threshold`` with ``recall``.

    A pair at the threshold is the least likely to be found, so what holds for it
    holds for all; the shortest prefix is one value.
    """
    out = [LEVELS]
    while out[-1] > 1 and found_at(out[-1], threshold) < recall:
        out.append(out[-1] - 1)
    return out


def least_agreement(threshold: float) -> int:
    """Signature values of ``TREES * LEVELS`` that a pair at ``threshold`` shares, but for one in millions."""
    n = TREES * LEVELS
    return max(1, int(np.floor(n * threshold - MARGIN * np.sqrt(n * threshold * (1 - threshold)))))


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch["text"]:
            shingles = shingles_of(text)
            print_ = xxhash.xxh3_128(shingles.tobytes()).digest()
            rows.append((
                int.from_bytes(print_[:8], "little", signed=True),
                int.from_bytes(print_[8:], "little", signed=True),
                signature(shingles).tobytes() if len(shingles) else None,
            ))
        yield pd.DataFrame(rows, columns=["fa", "fb", "sig"]).assign(
            doc_id=batch["doc_id"].astype("Int64").array, text_hash=batch["text_hash"].to_numpy()
        )


def _subtries(depth: int):
    """Each class once per tree, under the trie node of its first ``depth`` values."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sigs = np.frombuffer(b"".join(batch["sig"]), np.uint32).reshape(-1, TREES, LEVELS)
            total = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), sigs.shape[:2]).copy()
            for k in range(depth):
                total = (total ^ sigs[:, :, k]) * _STEP
                total ^= total >> np.uint64(31)
            yield pd.DataFrame({
                "grp": total.ravel().view(np.int64), "item": np.repeat(batch["item"].to_numpy(), TREES), "weight": 1,
                "tree": np.tile(np.arange(TREES), len(batch)), "sig": np.repeat(batch["sig"].to_numpy(), TREES),
            })

    return keys


def _agreeing(sigs: np.ndarray, tree: np.ndarray, i: np.ndarray, j: np.ndarray, agreement: int) -> np.ndarray:
    """Which pairs of rows, met in the trie of their ``tree``, agree in enough values and are this trie's.

    A pair is taken in one trie only: the first of those where its common prefix is longest.
    """
    out = np.zeros(len(i), bool)
    for low in range(0, len(i), 1 << 15):
        part = slice(low, low + (1 << 15))
        same = sigs[i[part]] == sigs[j[part]]
        prefix = np.logical_and.accumulate(same, axis=2).sum(axis=2)
        out[part] = (same.sum(axis=(1, 2)) >= agreement) & (prefix.argmax(axis=1) == tree[i[part]])
    return out


def _small_nodes(agreement: int):
    """``item, root`` of classes linked under nodes of few classes, a bundle of nodes at a time."""

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("grp", kind="stable")
        grp, item, tree = rows["grp"].to_numpy(), rows["item"].to_numpy("int64"), rows["tree"].to_numpy()
        sigs = np.frombuffer(b"".join(rows["sig"]), np.uint32).reshape(-1, TREES, LEVELS)
        root, apart, ends = item.copy(), 1, []
        while len(i := np.flatnonzero(grp[apart:] == grp[:-apart])):
            hit = _agreeing(sigs, tree, i, i + apart, agreement)
            ends.append((i[hit], i[hit] + apart))
            apart += 1
        i, j = (np.concatenate([e[side] for e in ends] or [np.empty(0, int)]) for side in (0, 1))
        while True:
            low = np.minimum(root[i], root[j])
            if (low == root[i]).all() and (low == root[j]).all():
                break
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
        return pd.DataFrame({"item": item, "root": root})[root != item]

    return link


def _large_nodes(lengths: list[int], agreement: int):
    """The same for ``compare_groups``: pairs of at most two blocks of a node.

    Signatures are sorted, so those with a long prefix in common are next to each
    other, and matched from the longest length of prefix to the shortest.
    """

    def compare(rows: pd.DataFrame):
        sigs = np.frombuffer(b"".join(rows["sig"]), np.uint32).reshape(-1, TREES, LEVELS)
        tree = rows["tree"].to_numpy()
        order = np.lexsort(sigs[:, tree[0], ::-1].T)
        sigs = sigs[order]
        linked, equal = np.zeros((len(sigs), len(sigs)), bool), np.ones((len(sigs), len(sigs)), bool)
        shared = np.zeros(equal.shape, np.int8)
        for k in range(LEVELS):
            equal &= sigs[:, None, tree[0], k] == sigs[None, :, tree[0], k]
            shared += equal
        for length, longer in zip(lengths, [LEVELS + 1, *lengths]):
            i, j = np.nonzero(np.triu((shared >= length) & (shared < longer), 1))
            hit = _agreeing(sigs, tree, i, j, agreement)
            linked[i[hit], j[hit]] = True
        out = np.zeros(linked.shape, bool)
        out[np.ix_(order, order)] = linked | linked.T
        return out, None

    return compare


def _candidates(trees: DataFrame, threshold: float, recall: float) -> DataFrame:
    """``item, root``: links between classes that share a trie node and most of their signature."""
    lengths, agreement = depths(threshold, recall), least_agreement(threshold)
    kind = "grp long, item long, weight long, tree int, sig binary"
    subtries = trees.mapInPandas(_subtries(lengths[-1]), kind)
    # Most classes are alone under their nodes; keys alone are counted to find the others.
    counts = subtries.groupBy("grp").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    nodes = stage(trees.mapInPandas(_subtries(lengths[-1]), kind).join(counts, "grp"), "nodes")
    small = nodes.where(F.col("_n") <= SMALL_NODE)
    bundles = max(1, math.ceil(small.count() / BUNDLE_ROWS))
    few = small.groupBy(F.pmod(F.xxhash64("grp"), F.lit(bundles))).applyInPandas(_small_nodes(agreement), "item long, root long")
    large = nodes.where(F.col("_n") > SMALL_NODE).drop("_n")
    many = compare_groups(large, _large_nodes(lengths, agreement), NODE_ROWS).where("item != root").select("item", "root")
    return stage(few.unionByName(many), "candidates")


def _shingled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        made = [shingles_of(t) for t in batch["text"]]
        prints = [xxhash.xxh3_128(s.tobytes()).digest() for s in made]
        same = [
            (int.from_bytes(p[:8], "little", signed=True), int.from_bytes(p[8:], "little", signed=True)) == (a, b)
            for p, a, b in zip(prints, batch["fa"], batch["fb"], strict=True)
        ]
        out = batch.assign(shingles=[s.tobytes() for s in made])[["node", "weight", "grp", "shingles"]]
        yield out[np.array(same, bool)]


def overlap(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted sets."""
    count = np.zeros((len(sets), len(sets)))
    values, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = often[place] > 1
    place, owner = (np.cumsum(often > 1) - 1)[place[shared]], owner[shared]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    for at in range(0, int(place[-1]) + 1 if len(place) else 0, _COLUMNS):
        low, high = np.searchsorted(place, [at, at + _COLUMNS])
        part = np.zeros((len(sets), _COLUMNS), np.float32)
        part[owner[low:high], place[low:high] - at] = 1
        count += part @ part.T
    return count


def _verify(threshold: float):
    def compare(rows: pd.DataFrame):
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        both = overlap(sets)
        size = np.array([len(s) for s in sets])
        likeness = both / np.maximum(size[:, None] + size[None, :] - both, 1)
        return likeness >= threshold - 1e-12, None

    return compare


def jaccard_join(docs: DataFrame, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """Near duplicates by Jaccard likeness of five-word shingles, ``threshold`` or more.

    1. Documents with equal shingle sets form a class (128-bit fingerprint).
    2. Each class has a MinHash signature, ``TREES`` tries of ``LEVELS`` values.
       Prefixes are shortened until a pair at ``threshold``, the least likely to be
       found, is found with ``recall``: no pair depends on what else is in the
       table.  Pairs that share a node are screened by how many of all signature
       values they have in common, large nodes in blocks, so texts that share
       a node by a common passage only are no candidates.
    3. Connected candidates are verified on their whole shingle sets, in blocks.

    Equal and nearly equal documents are never listed as pairs; a document's
    links are counted from class sizes.  Work on a group of near copies that
    differ is quadratic in its different texts, in tasks of bounded size.

    A missing text is empty; texts without words are one class and link with
    nothing else; a text of under five words has one shingle.  Rows without
    ``doc_id`` stay and link with nothing.  A repeated row is a copy like any
    other.  Other columns of ``docs`` are ignored.  No documents, no rows.

    Returns a row per document: ``doc_id, text_hash`` (``xxhash64`` of the text),
    ``class_id`` (smallest doc_id reachable by links), ``n_links`` (other documents
    linked directly) and ``kept`` (``doc_id = class_id``, or no id).
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Ids as text: a nullable number would pass through a double.
    sent = text.select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    signed = stage(sent.mapInPandas(_sign, "fa long, fb long, sig binary, doc_id long, text_hash long"), "signatures")
    classes = stage(
        signed.where("doc_id IS NOT NULL")
        .groupBy("fa", "fb")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("sig").alias("sig"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    trees = classes.where("sig IS NOT NULL").select(F.col("node").alias("item"), "sig")
    near = connected_components(_candidates(trees, threshold, recall))
    wanted = classes.join(near.withColumnRenamed("id", "node"), "node").select(
        "node", "weight", "fa", "fb", F.col("root").alias("grp"), F.col("rep").alias("doc_id")
    )
    made = text.join(wanted, "doc_id").drop("doc_id")
    sets = made.mapInPandas(_shingled, "node long, weight long, grp long, shingles binary").dropDuplicates(["node"])
    items = stage(sets.withColumnRenamed("node", "item"), "shingles")
    partial = stage(compare_groups(items, _verify(threshold), BLOCK_ROWS), "verified")

    roots = connected_components(partial.where("item != root").select("item", "root"))
    links = partial.groupBy("item").agg(F.sum("links").alias("links"))
    nodes = (
        classes.drop("sig")
        .join(roots.withColumnRenamed("id", "node"), "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .join(links.withColumnRenamed("item", "node"), "node", "left")
    )
    nodes = stage(nodes, "nodes")
    names = nodes.groupBy("root").agg(F.min("rep").alias("class_id"))
    named = nodes.join(names, "root").select(
        "fa", "fb", "class_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    found = signed.select("doc_id", "fa", "fb", "text_hash").join(named, ["fa", "fb"], "left")
    known = F.col("doc_id").isNotNull()
    return found.select(
        "doc_id",
        "text_hash",
        F.when(known, F.col("class_id")).alias("class_id"),
        F.when(known, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"),
    )
