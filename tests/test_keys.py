import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators.dedup import dedup_by, keep_max_rows, latest_per_key
from starloom.operators.keys import number_rows, with_unknown_member

HARBOURS = [  # two share a berth time, one has none
    ("Lerwick", 7, dt.datetime(1999, 1, 1)),
    ("Ystad", 3, dt.datetime(1999, 1, 1)),
    ("Calvi", 11, None),
    ("Sines", 2, dt.datetime(2004, 2, 29, 23, 59, 59)),
]


@pytest.fixture()
def harbours(spark):
    return spark.createDataFrame(HARBOURS, "town string, piers int, ValidFrom timestamp")


def numbered(df):
    return {r.town: r.Nr for r in df.collect()}


def test_the_key_column_goes_first_or_last(harbours):
    assert number_rows(harbours, "town", "Nr").columns == ["Nr", *harbours.columns]
    assert number_rows(harbours, "town", "Nr", key_first=False).columns == [*harbours.columns, "Nr"]


def test_missing_values_come_first_and_ties_follow_the_next_column(harbours):
    rows = number_rows(harbours.repartition(3), ["ValidFrom", "piers"], "Nr")
    assert numbered(rows) == {"Calvi": 0, "Ystad": 1, "Lerwick": 2, "Sines": 3}
    down = number_rows(harbours, [F.desc("piers")], "Nr", offset=40)
    assert numbered(down) == {"Calvi": 40, "Lerwick": 41, "Ystad": 42, "Sines": 43}


def test_type_of_the_key(harbours):
    small, large = number_rows(harbours, "town", "Nr"), number_rows(harbours, "town", "Nr", 3_000_000_000, key_type="bigint")
    assert (small.schema["Nr"].dataType.simpleString(), small.schema["Nr"].nullable) == ("int", False)
    assert sorted(numbered(large).values()) == [3_000_000_000 + k for k in range(4)]


def test_keys_equal_global_row_number_with_a_hot_value(spark):
    # two thirds of the rows share the leading order column
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id") % 97).alias("v"),
        (F.hash("id") % 1000).alias("w"),
        "id",
    )
    got = number_rows(df.repartition(7), ["v", "w", "id"], "K", 1).toPandas().sort_values(["v", "w", "id"])
    assert got.K.tolist() == list(range(1, 30_001))


def test_keys_of_duplicates_and_empty(spark):
    same = spark.range(100).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    assert sorted(r.K for r in number_rows(same, "a", "K", 5).collect()) == list(range(5, 105))
    assert number_rows(same.where("a = 2"), "a", "K").count() == 0


def test_number_rows_keeps_nullability(spark):
    df = spark.range(3).select("id", F.lit("a").alias("s"), F.lit(None).cast("string").alias("n"))
    out = number_rows(df, "id", "K").schema
    assert [f.nullable for f in out.fields] == [False, False, False, True]


def test_unknown_member(harbours):
    out = with_unknown_member(
        number_rows(harbours, "town", "Nr", 1), "Nr", {"town": "Nowhere", "piers": -1}, "1990-06-01", "9999-12-31"
    )
    zero = out.where("Nr = 0").first()
    assert (zero.town, zero.piers, zero.ValidFrom) == ("Nowhere", -1, dt.datetime(1990, 6, 1))
    assert numbered(out) == {"Nowhere": 0, "Calvi": 1, "Lerwick": 2, "Sines": 3, "Ystad": 4}


def test_dedup_is_deterministic_and_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 7, "c"), (None, 1, "d"), (None, 2, "e")], "k int, v int, s string")
    out = {(r.k, r.v) for r in dedup_by(df, "k", "v").collect()}
    assert out == {(1, 5), (None, 1)}
    once = {(r.k, r.v, r.s) for r in dedup_by(df, "k", "v").collect()}
    again = {(r.k, r.v, r.s) for r in dedup_by(df.repartition(3, "s"), "k", "v").collect()}
    assert once == again
    latest = {(r.k, r.s) for r in latest_per_key(df, "k", "v").collect()}
    assert latest == {(1, "c"), (None, "e")}
    plan = dedup_by(df, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_keep_max_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, 3), (1, 3), (2, 2), (None, 4)], "k int, v int")
    assert sorted((r.k or 0, r.v) for r in keep_max_rows(df, "k", "v").collect()) == [(0, 4), (1, 3), (1, 3), (2, 2)]
