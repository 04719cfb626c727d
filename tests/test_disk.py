"""What stays on disk: shuffles go with the write they were made for, staged tables with their last use."""

import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.operators import hot, temporal
from starloom.operators.checks import tables_equal
from starloom.operators.keys import number_parts, number_rows
from starloom.plans import facts
from starloom.plans.star import build_dimensions
from starloom.sources.staging import recorded, stage, stage_last, staging_folder, unrecorded, with_scratch

D = dt.datetime


def _tables(spark):
    return set(Path(staging_folder(spark), "starloom").glob("*"))


def _shuffles(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(n).getName() for n in range(files.length())) if name.startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle(spark):
    before = _shuffles(spark)
    rows = spark.range(1000).withColumn("k", F.col("id") % 7)
    staged = stage(rows.groupBy("k").agg(F.sum("id").alias("s")).repartitionByRange("s"), "sums")
    until = time.monotonic() + 20
    while _shuffles(spark) - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not _shuffles(spark) - before  # two stayed until the driver collected garbage
    assert staged.count() == 7


def test_a_comparison_leaves_no_shuffle(spark):
    rows = spark.range(1000).withColumn("k", F.col("id") % 7)
    one, two = stage(rows, "one"), stage(rows.repartition(3), "two")
    before = _shuffles(spark)
    assert tables_equal(one, two)
    until = time.monotonic() + 20
    while _shuffles(spark) - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not _shuffles(spark) - before  # the digests of both tables stayed


def test_parts_are_numbered_as_the_whole(spark):
    rows = spark.createDataFrame([(n * 7 % 20, n) for n in range(20)], "a int, b int")
    parts = [rows.where("a < 3"), rows.where("a >= 30"), rows.where("a >= 3")]
    whole = number_rows(rows, ["a"], "key", 5)
    assert sorted(number_parts(parts, ["a"], "key", 5).collect()) == sorted(whole.collect())
    assert number_parts(parts, ["a"], "key", keep=["b"]).columns == ["key", "b"]


def _order(spark, **options):
    far = D(2099, 1, 1)

    def versions(ids, *names):
        rows = [(n, n, D(2013, 1, 1), D(2016, 1, 1)) for n in ids] + [(n, n + 100, D(2016, 1, 1), far) for n in ids]
        return spark.createDataFrame(rows, f"{names[0]} int, {names[1]} int, ValidFrom timestamp, ValidTo timestamp")

    dims = [
        versions([1, 2], "WWICityID", "CityKey"), versions([5, 6, 7], "WWICustomerID", "CustomerKey"),
        versions([8, 9], "WWIStockItemID", "StockItemKey"), versions([3, 4], "WWIEmployeeID", "EmployeeKey"),
    ]
    packages = spark.createDataFrame([(1, "Box", D(2013, 1, 1))], "PackageTypeID int, PackageTypeName string, ValidFrom timestamp")
    customers = spark.createDataFrame([(5, 1, D(2013, 1, 1)), (6, None, D(2013, 1, 1)), (7, 2, D(2013, 1, 1))], "CustomerID int, DeliveryCityID int, ValidFrom timestamp")
    orders = spark.createDataFrame(
        [(n, 5 + n % 3, 3 + n % 2, None if n % 4 == 0 else 4, None, dt.date(2015, 1, 1), D(2015 + n % 2, 6, n), D(2015, 12, 2)) for n in (*range(1, 9), 8)],
        "OrderID int, CustomerID int, SalespersonPersonID int, PickedByPersonID int, BackorderOrderID int, OrderDate date, LastEditedWhen timestamp, LoadDatetime timestamp",
    )
    lines = spark.createDataFrame(
        [(n % 3, n % 10 or None, (8, 9, 7, None)[n % 4], D(2014 + n % 4, 2, 1)) for n in range(1, 40)],
        "OrderLineID int, OrderID int, StockItemID int, LastEditedWhen timestamp",
    ).select(
        "*", F.lit("d").alias("Description"), F.lit(1).alias("PackageTypeID"), F.lit(2).alias("Quantity"), F.lit(3).cast("decimal(18,2)").alias("UnitPrice"),
        F.lit(15).cast("decimal(18,3)").alias("TaxRate"), F.col("LastEditedWhen").alias("PickingCompletedWhen"),
    )
    return facts.order(orders, lines, packages, customers, *dims, **options)


@pytest.mark.parametrize("options", [{}, {"grain": "item"}, {"grain": "item", "earliest_key": True, "offset": 3}])
@pytest.mark.parametrize("large", [False, True])
def test_a_fact_in_parts_is_the_fact(spark, monkeypatch, options, large):
    want = sorted(map(str, _order(spark, **options).collect()))
    placed = []
    monkeypatch.setattr(facts, "PART_DOCUMENTS", 2)
    monkeypatch.setattr(facts, "number_parts", lambda parts, *a, **b: placed.append(len(parts)) or number_parts(parts, *a, **b))
    if large:
        monkeypatch.setattr(temporal, "BROADCAST_ROWS", 1)
        monkeypatch.setattr(hot, "ATTACH_KEYS", 0)
    before = _tables(spark)
    fact = _order(spark, **options)
    left = [t.name.rsplit("-", 1)[0] for t in _tables(spark) - before]
    assert sorted(map(str, fact.collect())) == want and placed[0] > 1
    if large and options.get("earliest_key"):
        # The numbered lines stayed beside those with their earliest keys.
        assert "earliest" in left and "keys-OrderKey" not in left and "per-key" not in left


def test_tables_go_with_their_last_use(spark):
    with recorded() as made:
        first = stage(spark.range(3), "first")
        with unrecorded():
            shared = stage(spark.range(4), "shared")
    before = _tables(spark)
    kept = stage_last(with_scratch(first.withColumn("k", F.lit(1)), made), "kept")
    assert [t.name.split("-")[0] for t in before - _tables(spark)] == ["first"]
    assert kept.count() == 3 and shared.count() == 4


def test_dimensions_leave_only_themselves(spark):
    people = spark.createDataFrame(
        [(1, "a", "b", True, True, None, D(2013, 1, 1), D(2099, 1, 1), D(2013, 1, 2))],
        "PersonID int, FullName string, PreferredName string, IsEmployee boolean, IsSalesperson boolean, Photo string, ValidFrom timestamp, ValidTo timestamp, LoadDatetime timestamp",
    )
    before = _tables(spark)
    built = build_dimensions({"application_people": people}, "2018-06-01 00:00:00", ["employee"])["employee"]
    assert [t.name.rsplit("-", 1)[0] for t in _tables(spark) - before] == ["dimension-employee"]
    assert built.count() == 2
