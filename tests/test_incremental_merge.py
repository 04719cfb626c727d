import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators.incremental import (
    MissingLoadColumn,
    as_of_load,
    fact_window,
    high_water_mark,
    key_offset,
    load_filter,
    since_date,
    stamp,
    temporal_union,
    window_filter,
)
from starloom.operators.merge import MergeConflict, fact_merge, merge_all, merge_keep_stamp, merge_upsert
from starloom.plans.raw_load import load_regular, load_temporal

DAY = dt.datetime(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


@pytest.fixture()
def loads(spark):
    return spark.createDataFrame([(i, day(i)) for i in range(1, 6)], "id int, LoadDatetime timestamp")


def test_high_water_mark(loads):
    assert high_water_mark(loads) == day(5)
    assert high_water_mark(loads.where("id > 9")) is None


def test_windows_are_open_below_and_closed_above(loads):
    assert [r.id for r in load_filter(loads, day(2), day(4)).collect()] == [3, 4]
    assert [r.id for r in window_filter(loads, "LoadDatetime", None, day(2)).collect()] == [1, 2]
    assert as_of_load(loads, None).count() == 5
    assert as_of_load(loads, day(3)).count() == 3


def test_fact_window_needs_both_bounds(loads):
    assert fact_window(loads, day(2), None).count() == 5
    assert fact_window(loads, None, day(2)).count() == 5
    assert fact_window(loads, day(2), day(3)).count() == 1


def test_missing_load_column(loads):
    with pytest.raises(MissingLoadColumn):
        load_filter(loads.drop("LoadDatetime"), day(1), day(2))


def test_next_key_and_since(spark):
    fact = spark.createDataFrame([(k, dt.datetime(2022, 7, 25)) for k in range(1, 35)], "SaleKey int, RawDataLoadDatetime timestamp")
    gaps = fact.where("SaleKey % 7 > 0").unionAll(fact.limit(1).select(F.lit(35), "RawDataLoadDatetime"))
    assert key_offset(fact, "SaleKey") == 35
    assert key_offset(gaps, "SaleKey") == 36
    assert key_offset(None, "SaleKey") == 0
    assert key_offset(fact.where("SaleKey < 0"), "SaleKey") == 1
    assert since_date(fact) == dt.datetime(2022, 7, 25)
    for none in (None, fact.where("SaleKey < 0")):
        assert str(since_date(none)).startswith("1900-01-01")


def test_filter_reaches_the_scan(spark, tmp_path, loads):
    loads.write.parquet(str(tmp_path / "t"))
    plan = load_filter(spark.read.parquet(str(tmp_path / "t")), day(2), day(4))._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(LoadDatetime), GreaterThan(LoadDatetime" in plan


def history(spark, rows):
    return spark.createDataFrame([(i, day(a), day(b)) for i, a, b in rows], "id int, ValidFrom timestamp, ValidTo timestamp")


def test_temporal_union(spark):
    current = history(spark, [(1, 5, 99), (2, 2, 99), (3, 12, 99)])
    archive = history(spark, [(1, 0, 5), (1, 0, 5), (3, 1, 12), (2, 2, 99)])
    first = sorted((r.id, r.ValidFrom) for r in temporal_union(current, archive, to=day(10)).collect())
    assert first == [(1, day(0)), (1, day(0)), (1, day(5)), (2, day(2)), (2, day(2)), (3, day(1))]
    later = sorted((r.id, r.ValidFrom) for r in temporal_union(current, archive, day(3), day(12)).collect())
    assert later == [(1, day(0)), (1, day(5)), (3, day(1)), (3, day(12))]
    assert temporal_union(current, archive).count() == 5


MERGE_SCHEMA = "k int, v string, LoadDatetime int"


@pytest.mark.parametrize("method", ["broadcast", "outer"])
class TestMerge:
    def test_update_insert_survive_and_null_keys(self, spark, method):
        target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 1)], MERGE_SCHEMA)
        source = spark.createDataFrame([(2, None, 2), (3, "c", 2), (None, "m", 2)], MERGE_SCHEMA)
        got = merge_all(target, source, "k", method=method)
        assert got.columns == ["k", "v", "LoadDatetime"]
        rows = {(r.k, r.v, r.LoadDatetime) for r in got.collect()}
        assert rows == {(1, "a", 1), (2, None, 2), (3, "c", 2), (None, "n", 1), (None, "m", 2)}

    def test_keep_stamp(self, spark, method):
        target = spark.createDataFrame([(1, "a", 1)], MERGE_SCHEMA)
        source = spark.createDataFrame([(1, "b", 2), (2, "c", 2)], MERGE_SCHEMA)
        rows = {tuple(r) for r in merge_keep_stamp(target, source, "k", method=method).collect()}
        assert rows == {(1, "b", 1), (2, "c", 2)}

    def test_fact_keys(self, spark, method):
        schema = "key int, a int, b int, v string"
        target = spark.createDataFrame([(7, 1, 1, "old")], schema)
        source = spark.createDataFrame([(50, 1, 1, "new"), (51, 1, 2, "x")], schema)
        keep = {tuple(r) for r in fact_merge(target, source, ["a", "b"], "key", method=method).collect()}
        assert keep == {(7, 1, 1, "new"), (51, 1, 2, "x")}
        rekey = {tuple(r) for r in fact_merge(target, source, ["a", "b"], "key", rekey=True, method=method).collect()}
        assert rekey == {(50, 1, 1, "new"), (51, 1, 2, "x")}

    def test_conflicts(self, spark, method):
        target = spark.createDataFrame([(1, "a", 1)], MERGE_SCHEMA)
        twice = spark.createDataFrame([(1, "b", 2), (1, "c", 2)], MERGE_SCHEMA)
        with pytest.raises(MergeConflict):
            merge_all(target, twice, "k", method=method)
        # repeated keys that match nothing are all inserted
        fresh = spark.createDataFrame([(5, "b", 2), (5, "c", 2)], MERGE_SCHEMA)
        assert merge_all(target, fresh, "k", method=method).count() == 3

    def test_guard(self, spark, method):
        target = spark.createDataFrame([(1, "a", 5), (2, "a", 1)], MERGE_SCHEMA)
        source = spark.createDataFrame([(1, "late", 4), (2, "new", 4), (3, "first", 4)], MERGE_SCHEMA)
        guard = F.col("source.LoadDatetime") >= F.col("target.LoadDatetime")
        rows = {tuple(r) for r in merge_upsert(target, source, "k", guard=guard, method=method).collect()}
        assert rows == {(1, "a", 5), (2, "new", 4), (3, "first", 4)}


def test_merge_columns_must_agree(spark):
    target = spark.createDataFrame([(1, "a", 1)], MERGE_SCHEMA)
    with pytest.raises(ValueError):
        merge_all(target, target.drop("v"), "k")


def test_small_source_leaves_the_target_unshuffled(spark):
    target = spark.range(100_000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    plan = merge_upsert(target, target.limit(10), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan and "FullOuter" not in plan


def test_regular_load_twice(spark):
    schema = "id int, v string, LastEditedWhen timestamp"
    source = spark.createDataFrame([(1, "a", day(1)), (2, "b", day(2)), (3, "c", day(9))], schema)
    empty = stamp(source.where("false"), day(0))
    first = load_regular(empty, source, "id", day(5))
    assert {(r.id, r.LoadDatetime) for r in first.collect()} == {(1, day(5)), (2, day(5))}
    edited = spark.createDataFrame([(1, "a2", day(7)), (2, "b", day(2)), (3, "c", day(9)), (4, "d", day(11))], schema)
    second = {(r.id, r.v, r.LoadDatetime) for r in load_regular(first, edited, "id", day(10)).collect()}
    assert second == {(1, "a2", day(10)), (2, "b", day(5)), (3, "c", day(10))}


def test_temporal_load_twice(spark):
    current, archive = history(spark, [(1, 0, 99)]), history(spark, [(1, 0, 0)]).where("false")
    empty = stamp(current.where("false"), day(0))
    first = load_temporal(empty, current, archive, "id", day(5))
    later = load_temporal(first, history(spark, [(1, 7, 99)]), history(spark, [(1, 0, 7)]), "id", day(10))
    rows = {(r.id, r.ValidFrom, r.ValidTo, r.LoadDatetime) for r in later.collect()}
    assert rows == {(1, day(0), day(7), day(5)), (1, day(7), day(99), day(10))}
