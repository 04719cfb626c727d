"""Mixing to target weights: iterative proportional fitting, then calibrated sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.sources.staging import stage

DIMENSIONS = {"source": 0.9, "lang": 0.9, "topic": 0.9}  # target share: proportional to tokens ** power
ROUNDS_A_JOB = 4
MOST_ROUNDS = 60
TOLERANCE = 1e-8
KEEP = 0.9  # share of all tokens to keep, as far as no probability exceeds 1


def tokens_of(text: Column) -> Column:
    """Number of runs without white space; 0 for a missing text."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\r]+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """A plain rule-based topic; a missing text is short prose."""
    return (
        F.when(text.contains("Licensed under") | text.contains("Copyright"), "licence")
        .when(text.contains(" | "), "table")
        .when(text.contains("@"), "contact")
        .when(F.length(text) >= 2_000, "long prose")
        .otherwise("short prose")
    )


def unit_interval(key: Column, seed: str = "mix") -> Column:
    """A number in [0, 1) from the hash of a key; missing keys share one."""
    text = F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """Weights of ``cells`` (dimension columns, ``tokens``) that meet all targets.

    ``targets[d]`` has the columns ``d, share``; shares of a dimension add up to
    1 over the values that occur.  In turn, each dimension's weights are scaled
    to its target, until no marginal is further off than ``TOLERANCE`` or after
    ``MOST_ROUNDS`` rounds (targets that contradict each other never fit).
    A window per dimension sums the cells of a value (one row per combination of
    values, not per document); every few rounds are written, which cuts the
    lineage.
    """
    weighted = cells.withColumn("weight", F.lit(1.0))
    for name, share in targets.items():
        weighted = weighted.join(share.withColumnRenamed("share", f"_share_{name}"), name)
    part = lambda name: F.sum(F.col("tokens") * F.col("weight")).over(Window.partitionBy(name))
    for _ in range(0, MOST_ROUNDS, ROUNDS_A_JOB):
        for _ in range(ROUNDS_A_JOB):
            for name in targets:
                weighted = weighted.withColumn("weight", F.col("weight") * F.col(f"_share_{name}") / part(name))
        # The last dimension fits exactly; how far off the others are is written with the weights.
        off = reduce(F.greatest, [F.abs(part(name) - F.col(f"_share_{name}")) for name in list(targets)[:-1]] * 2)
        weighted = stage(weighted.withColumn("_off", off), "raked")
        worst = weighted.agg(F.max("_off")).first()[0]
        weighted = weighted.drop("_off")
        if worst is None or worst <= TOLERANCE:
            break
    return weighted.select(*cells.columns, "weight")


def power_targets(cells: DataFrame, powers: dict[str, float]) -> dict[str, DataFrame]:
    """Target shares of each dimension, proportional to a power of its tokens."""
    out = {}
    for name, power in powers.items():
        sums = cells.groupBy(name).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("_p"))
        whole = sums.agg(F.sum("_p")).first()[0] or 1.0  # one number
        out[name] = stage(sums.select(name, (F.col("_p") / F.lit(whole)).alias("share")), "target")
    return out


def clipped_scale(cells: DataFrame, keep: float) -> float:
    """The scale at which ``least(1, weight * scale)`` keeps ``keep`` of all tokens.

    Each round caps the cells that the last scale brings to 1 and solves for the
    others.  Scales only grow, so it ends; one row comes back a round.
    """
    tokens = cells.agg(F.sum("tokens")).first()[0] or 0
    scale, capped = float(keep * tokens), -1
    while True:
        full = F.col("weight") * F.lit(scale) >= 1
        free = F.sum(F.when(~full, F.col("weight") * F.col("tokens")))
        now, whole, rest = cells.agg(F.count(F.when(full, 1)), F.sum(F.when(full, F.col("tokens"))), free).first()
        if now == capped or not rest:
            return scale
        capped, scale = now, max(scale, (keep * tokens - (whole or 0)) / rest)


def mixing_cells(docs: DataFrame, powers: dict[str, float] | None = None, keep: float = KEEP, clip: bool = False) -> DataFrame:
    """``source, lang, topic, tokens, weight, probability`` of every cell that has tokens.

    ``docs``: ``source, lang, topic, tokens``; missing values are "".  ``weight``
    times tokens is the cell's share of the target mixture.  Probabilities are
    proportional to weights and keep ``keep`` of all tokens, or less where a
    cell would need more than it has.  With ``clip`` such cells are kept whole
    and the others make up for them, so ``keep`` is met; ``unmet`` is then the
    share of the kept tokens that a cell lacks (or, below 0, has too much).
    """
    powers = powers or DIMENSIONS
    names = list(powers)
    cells = stage(
        docs.groupBy(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names])
        .agg(F.sum("tokens").alias("tokens"))
        .where("tokens > 0"),
        "cells",
    )
    raked = rake(cells, power_targets(cells, powers))
    if clip:
        chance = F.least(F.lit(1.0), F.col("weight") * F.lit(clipped_scale(raked, keep)))
        clipped = stage(raked.withColumn("probability", chance), "mixture")
        kept = clipped.agg(F.sum(F.col("tokens") * F.col("probability"))).first()[0] or 1.0  # one number
        return clipped.withColumn("unmet", F.col("tokens") * (F.col("weight") - F.col("probability") / F.lit(kept)))
    most, tokens = raked.agg(F.max("weight"), F.sum("tokens")).first()
    scale = min(keep * tokens, 1 / most) if most else 0.0
    return stage(raked.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(scale))), "mixture")


def with_cells(docs: DataFrame, cells: DataFrame, prefix: str) -> DataFrame:
    """``docs`` with ``<prefix>weight, <prefix>probability`` of its cell.

    ``docs`` has ``<prefix>source`` and so on.  Documents without tokens are in
    no cell: weight 0, probability 1, they stay and weigh nothing.
    """
    names = [c for c in cells.columns if c not in ("tokens", "weight", "probability", "unmet")]
    renamed = cells.select(*[F.col(c).alias(f"_cell_{c}") for c in (*names, "weight", "probability")])
    same = reduce(lambda a, b: a & b, [F.col(f"{prefix}{c}") == F.col(f"_cell_{c}") for c in names])
    joined = docs.join(renamed, same, "left").drop(*[f"_cell_{c}" for c in names])
    tokens = F.col(f"{prefix}tokens") > 0
    weight = F.when(tokens, F.col("_cell_weight")).otherwise(0.0)
    chance = F.when(tokens, F.col("_cell_probability")).otherwise(1.0)
    return (
        joined.withColumn(f"{prefix}weight", weight)
        .withColumn(f"{prefix}probability", chance)
        .drop("_cell_weight", "_cell_probability")
    )


def mix(docs: DataFrame, id_col: str = "doc_id", prefix: str = "_mix_", seed: str = "mix", clip: bool = False) -> DataFrame:
    """``docs`` with ``<prefix>`` columns: source, lang, topic, tokens, weight, probability, kept.

    Every document is drawn by itself with the probability of its cell, by a
    hash of its id, so equal input gives equal output.  Rows that repeat an id
    are kept or left together, as are all rows without an id of one cell.  With
    ``clip`` (see ``mixing_cells``) the text is hashed with the id, and only
    rows equal in both go together.
    ``docs`` needs ``source, lang, text`` and the id; all its columns come back,
    so ``prefix`` must be one that no column has.
    """
    text = F.col("text").cast("string")
    named = docs.select(
        "*",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias(f"{prefix}source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias(f"{prefix}lang"),
        F.coalesce(topic_of(text), F.lit("short prose")).alias(f"{prefix}topic"),
        tokens_of(text).alias(f"{prefix}tokens"),
    )
    cells = mixing_cells(named.select(*[F.col(f"{prefix}{c}").alias(c) for c in (*DIMENSIONS, "tokens")]), clip=clip)
    chosen = with_cells(named, cells, prefix)
    key = F.col(id_col)
    if clip:
        key = F.concat_ws(" ", F.xxhash64(text).cast("string"), key.cast("string"))
    return chosen.withColumn(f"{prefix}kept", unit_interval(key, seed) < F.col(f"{prefix}probability"))
