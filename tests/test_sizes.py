"""What is known of a written table, and which jobs that saves."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import hot, temporal
from starloom.operators.sizes import bounded, known_history, known_rows, stage_counted, stage_history

T0 = dt.datetime(2020, 1, 1)
SCHEMA = "id int, ValidFrom timestamp, ValidTo timestamp, v string"


def history(spark, rows):
    return spark.createDataFrame([(i, T0 + dt.timedelta(days=a), T0 + dt.timedelta(days=b), "x" * i) for i, a, b in rows], SCHEMA)


@pytest.mark.parametrize("overlap", [False, True])
def test_history_is_measured_by_its_write(spark, overlap):
    rng = random.Random(3)
    rows = [(i, 3 * n, 3 * n + rng.choice([0, 1, 3])) for i in range(1, 9) for n in range(rng.randint(1, 9))]
    rows += [(5, -1, 60), (5, 40, 41)] * overlap + [(5, 2, 2)]
    frame = history(spark, rows)
    staged = stage_history(frame, "measured", "id")
    assert staged.exceptAll(frame).count() == frame.exceptAll(staged).count() == 0
    known = known_history(staged, "id")
    assert known.rows == known_rows(staged) == len(rows) and known.disjoint != overlap
    real = [r for r in rows if r[1] < r[2]]
    assert known.most == max(sum(r[0] == i for r in real) for i in range(1, 9))
    assert known_history(staged, "v") is None and known_history(staged.where("id > 1"), "id") is None
    measured = temporal.lookup_methods({"h": (frame, ["id"], ["v"])})["h"]
    assert temporal.lookup_methods({"h": (staged, ["id"], ["v"])})["h"] == measured


def test_known_histories_start_no_job(spark):
    staged = stage_history(history(spark, [(1, 0, 5), (1, 5, 9), (2, 0, 9)]), "measured", ["id"])
    jobs = _jobs(spark, lambda: temporal.lookup_methods({"h": (staged, ["id"], ["v"])}))
    assert jobs == 0
    assert _jobs(spark, lambda: hot.find_hot(staged, ["id"], "ValidFrom")) == 0
    assert _jobs(spark, lambda: temporal.lookup_methods({"h": (staged.where("id > 0"), ["id"], ["v"])})) > 0
    found = hot.find_hot(staged, ["id"], "ValidFrom", hot_rows=1)
    assert [r.id for r in found.collect()] == [1]


def test_limits_still_hold_for_known_histories(spark, monkeypatch):
    staged = stage_history(history(spark, [(1, n, n + 1) for n in range(40)]), "measured", ["id"])

    def pick():
        found = temporal.lookup_methods({"h": (staged, ["id"], ["v"])})["h"]
        return *found, found.shallow

    assert pick() == ("broadcast", True, True)
    monkeypatch.setattr(temporal, "SCAN_VERSIONS", 39)
    assert pick() == ("merge", True, False)
    monkeypatch.setattr(temporal, "SCAN_VERSIONS", 40)
    monkeypatch.setattr(temporal, "BROADCAST_ROWS", 39)
    assert pick() == ("merge", True, True)
    monkeypatch.setattr(temporal, "BROADCAST_ROWS", 40)
    monkeypatch.setattr(temporal, "BROADCAST_BYTES", 100)
    # all columns are too much; those that are taken are measured
    assert temporal.lookup_methods({"h": (staged, ["id"], [])})["h"].method == "merge"


def test_counts_and_empty_tables(spark):
    frame = spark.range(5).withColumn("g", F.col("id") % 2)
    assert known_rows(stage_counted(frame, "counted")) == 5 and known_rows(frame) is None
    empty = stage_counted(frame.where("id < 0"), "counted")
    assert known_rows(empty) in (0, None) and empty.count() == 0
    none = stage_history(history(spark, [(1, 0, 1)]).where("false"), "none", "id")
    assert none.count() == 0 and temporal.lookup_methods({"h": (none, ["id"], ["v"])})["h"].disjoint
    assert known_rows(bounded(frame, None)) is None and known_rows(bounded(frame, 7)) == 7


def test_large_shallow_histories_take_one_equi_join(spark, monkeypatch):
    monkeypatch.setattr(temporal, "BROADCAST_ROWS", 0)
    left, right = history(spark, [(1, 0, 5), (2, 3, 9)]), history(spark, [(1, 4, 6), (2, 0, 3), (2, 9, 12), (3, 0, 9)])
    joined = temporal.overlap_join(left, right, "id", {"other": "v"})
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    assert joined.count() == temporal.overlap_join(left, right, "id", {"other": "v"}, method="merge").count() == 3


def _jobs(spark, work):
    group = f"count-{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
