"""Joins whose rows gather at one tree node or one version, against plain joins."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import hot
from starloom.operators.dedup import keep_max_rows
from starloom.operators.hot import attach_per_key
from starloom.operators.temporal import earliest_keys, overlap_join

T0 = dt.datetime(2020, 1, 1)
SCHEMA = "id int, ValidFrom timestamp, ValidTo timestamp, v int"


def history(spark, seed, n, name="v"):
    rng = random.Random(seed)
    rows = []
    for v in range(n):
        a = T0 + dt.timedelta(hours=rng.randrange(24 * 300))
        owner = None if rng.random() < 0.02 else 1 if rng.random() < 0.8 else rng.randrange(2, 6)
        rows.append((owner, a, a + dt.timedelta(hours=rng.choice([-5, 0, 1, 30, 900, 9_000])), v))
    rows += rows[:5]  # repeated
    return spark.createDataFrame(rows, SCHEMA).withColumnRenamed("v", name)


@pytest.mark.parametrize("unit", ["day", "month", "year"])
@pytest.mark.parametrize("hot_rows", [7, 60, 1_000_000])
def test_hot_nodes_lose_and_repeat_nothing(spark, unit, hot_rows):
    left, right = history(spark, 1, 250), history(spark, 2, 180, "w")
    plain = overlap_join(left, right, "id", {"w": "w"}, method="join")
    tree = overlap_join(left, right, "id", {"w": "w"}, method="merge", bin_unit=unit, hot_rows=hot_rows)
    assert tree.exceptAll(plain).count() == plain.exceptAll(tree).count() == 0


def test_no_part_of_a_hot_node_is_large(spark):
    left, right = history(spark, 3, 400), history(spark, 4, 400, "w")
    joined = overlap_join(left, right, "id", {"w": "w"}, method="merge", bin_unit="year", hot_rows=20)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_lpart" in plan and "_rcopy" in plan


@pytest.mark.parametrize("keys", [0, 100])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_attached_values(spark, monkeypatch, keys, how):
    monkeypatch.setattr(hot, "ATTACH_KEYS", keys)
    rows = [(1, "a", k) for k in range(300)] + [(2, "b", k) for k in range(9)] + [(None, "c", 1), (None, "c", 2), (7, None, 3)]
    df = spark.createDataFrame(rows, "k int, g string, n int")
    per_key = df.where("k IS NULL OR k < 7").groupBy(F.col("k").alias("_k"), F.col("g").alias("_g"))
    per_key = per_key.agg(F.max("n").alias("top"), F.count(F.lit(1)).alias("rows"))
    got = attach_per_key(df, per_key, [("k", "_k"), ("g", "_g")], "rows", how, hot_rows=50)
    top = {1: 299, 2: 8, None: 2}
    want = [(k, n, top.get(k)) for k, _, n in rows if how == "left" or k in top]
    assert sorted(((r.k, r.n, r.top) for r in got.collect()), key=str) == sorted(want, key=str)
    assert "rows" not in got.columns


@pytest.mark.parametrize("keys", [0, 1_000])
def test_earliest_keys_and_largest_rows_with_most_rows_on_one_version(spark, monkeypatch, keys):
    monkeypatch.setattr(hot, "ATTACH_KEYS", keys)
    rng = random.Random(9)
    rows = [(None, None, None, n) if n % 17 == 0 else (rng.randrange(100), 1 if n % 10 < 8 else n % 4, 5 if n % 10 < 6 else n % 9, n) for n in range(400)]
    df = spark.createDataFrame(rows, "key int, member int, since int, n int")
    got = {r.n: r.key for r in earliest_keys(df, [("key", "member", "since")], hot_rows=30).collect()}
    assert got == {
        n: None if m is None else min(k2 for k2, m2, s2, _ in rows if m2 == m and s2 <= s) for k, m, s, n in rows
    }
    most = keep_max_rows(df, ["member"], "since", hot_rows=30)
    want = sorted(n for _, m, s, n in rows if m is not None and s == max(s2 for _, m2, s2, _ in rows if m2 == m))
    assert sorted(r.n for r in most.collect()) == want


def test_pairs_compared_under_hot_ids_grow_with_the_rows(spark):
    # One id, its versions end to end within a month: a month's bin would compare each with each.
    from starloom.operators.temporal import intersect_join, version_timeline

    def chain(n, first, step, name):
        at = F.timestamp_seconds(F.lit(1_577_836_800) + F.col("id") * step + first)
        rows = spark.range(n).select(F.lit(1).alias("id"), at.alias("ValidFrom"), F.col("id").alias(name))
        return version_timeline(rows, "id", "ValidFrom", default_end="2099-12-31 00:00:00")

    for n in (500, 2_000):
        left, right = chain(n, 0, 60, "v"), chain(n, 7, 60, "w")
        joined = intersect_join(left, right, "id", {"w": "w"}, method="merge", bin_unit="month", hot_rows=50)
        assert len(joined.collect()) == 2 * n - 1
        assert 0 < _rows_into_joins(joined._jdf.queryExecution().executedPlan()) < 40 * n


def _rows_into_joins(plan):
    """Rows that all explodes of an executed plan gave."""
    text, total, todo = "numOutputRows", 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if node.nodeName() == "Generate":
            total += node.metrics().apply(text).value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("scan", [3, 1_000])
@pytest.mark.parametrize("closed", ["left", "right"])
def test_overlapping_versions_in_a_tree_and_in_one_join(spark, monkeypatch, scan, closed):
    from starloom.operators import temporal

    monkeypatch.setattr(temporal, "SCAN_VERSIONS", scan)
    versions = history(spark, 5, 90, "w").withColumn("w", F.struct("w", F.lit(0)).getField("w"))
    points = history(spark, 6, 120).select("id", F.col("ValidFrom").alias("at"), "v")
    rows = {(r.id, r.ValidFrom, r.ValidTo, r.w) for r in versions.collect() if r.id and r.ValidFrom < r.ValidTo}
    want = []
    for r in points.collect():
        held = [h for h in rows if h[0] == r.id and (h[1] <= r["at"] < h[2] if closed == "left" else h[1] < r["at"] <= h[2])]
        want.append((r.v, max(held, key=lambda h: h[1:])[3] if held else None))
    found = temporal.as_of_join(points, versions, "id", "at", {"w": "w"}, "left", closed, method="merge")
    assert sorted(((r.v, r.w) for r in found.collect()), key=str) == sorted(want, key=str)
    # The flattened history is a written table: the look-up holds no tree.
    assert "shiftright" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("scan", [3, 1_000])
def test_every_match_of_few_versions_copies_no_row(spark, monkeypatch, scan):
    from starloom.operators import temporal

    monkeypatch.setattr(temporal, "SCAN_VERSIONS", scan)
    versions = history(spark, 7, 60, "w")
    points = history(spark, 8, 80).select("id", F.col("ValidFrom").alias("at"), "v")
    found = temporal.as_of_join(points, versions, "id", "at", {"w": "w"}, "left", method="merge", matches="all")
    plain = temporal.as_of_join(points, versions, "id", "at", {"w": "w"}, "left", method="join", matches="all", disjoint=True)
    assert sorted(found.collect(), key=str) == sorted(plain.collect(), key=str)
    assert ("shiftright" in found._jdf.queryExecution().optimizedPlan().toString()) == (scan == 3)
