"""Look-ups of facts in histories too large to send around: lines move once per step, however many roles there are."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import hot, temporal
from starloom.operators.temporal import as_of_join, earliest_keys, packed_versions, version_at, versions_between
from starloom.plans import facts

D = dt.datetime


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_minima_of_many_roles_read_the_rows_once_per_role(spark, monkeypatch):
    monkeypatch.setattr(hot, "ATTACH_KEYS", 0)
    rows = [(n, n % 7, n % 3, D(2020, 1, 1 + n % 5)) for n in range(60)] + [(60, None, None, None)]
    df = spark.createDataFrame(rows, "id int, k int, m int, s timestamp").select(
        "id", *[F.col(c).alias(f"{c}{i}") for i in range(4) for c in "kms"]
    )
    roles = [(f"k{i}", f"m{i}", f"s{i}") for i in range(4)]
    got = earliest_keys(df, roles, row="id")
    want = {n: min((q[1] for q in rows[:60] if q[2] == m and q[3] <= s), default=None) if m is not None else None for n, _, m, s in rows}
    assert {r.id: [r[f"k{i}"] for i in range(4)] for r in got.collect()} == {n: [k] * 4 for n, k in want.items()}
    # Joined role by role, the union of hot and other rows doubled the reads for each role.
    assert _plan(got).count("Relation") <= 1 + 4 * 5


@pytest.mark.parametrize("overlap", [False, True])
def test_packed_versions_equal_the_join(spark, overlap):
    spans = [(1, 10, 1, 4), (1, 11, 4, 9), (2, 20, 2, 2), (2, 21, 3, 8), (None, 30, 1, 9)]
    spans += [(1, 12, 2, 6), (1, 13, 2, 6), (2, 22, 3, 5)] if overlap else []
    history = spark.createDataFrame([(m, k, D(2020, 1, a), D(2020, 1, b)) for m, k, a, b in spans], "m int, k int, ValidFrom timestamp, ValidTo timestamp")
    asked = [(ref, D(2020, 1, at) if at else None) for ref in (1, 2, 3, None) for at in (*range(1, 11), None)]
    left = spark.createDataFrame([(n, *a) for n, a in enumerate(asked)], "n int, ref int, at timestamp")
    want = as_of_join(left, history, [("ref", "m")], "at", {"k": "k"}, "left", "right", method="merge")
    packed = packed_versions(history, "m", ["k"], "v")
    got = left.join(packed, F.col("ref") == F.col("m"), "left")
    got = got.withColumn("v", versions_between(F.col("v"), F.col("at"), F.col("at")))
    got = got.select("n", "ref", "at", version_at(F.col("v"), F.col("at"))["k"].alias("k"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_large_histories_of_few_versions_sort_no_lines(spark, monkeypatch):
    monkeypatch.setattr(temporal, "BROADCAST_ROWS", 1)
    far = D(2099, 1, 1)

    def versions(ids, *names):
        rows = [(n, n, D(2013, 1, 1), D(2016, 1, 1)) for n in ids] + [(n, n + 100, D(2016, 1, 1), far) for n in ids]
        return spark.createDataFrame(rows, f"{names[0]} int, {names[1]} int, ValidFrom timestamp, ValidTo timestamp")

    dims = [
        versions([1, 2], "WWICityID", "CityKey"), versions([5, 6], "WWICustomerID", "CustomerKey"),
        versions([8, 9], "WWIStockItemID", "StockItemKey"), versions([3, 4], "WWIEmployeeID", "EmployeeKey"),
    ]
    packages = spark.createDataFrame([(1, "Box", D(2013, 1, 1))], "PackageTypeID int, PackageTypeName string, ValidFrom timestamp")
    customers = spark.createDataFrame([(5, 1, D(2013, 1, 1)), (6, None, D(2013, 1, 1))], "CustomerID int, DeliveryCityID int, ValidFrom timestamp")
    orders = spark.createDataFrame(
        [(1, 5, 3, 4, None, dt.date(2015, 1, 1), D(2015, 12, 1), D(2015, 12, 2)), (2, 6, 3, None, 1, dt.date(2015, 1, 1), None, D(2015, 12, 2))],
        "OrderID int, CustomerID int, SalespersonPersonID int, PickedByPersonID int, BackorderOrderID int, OrderDate date, LastEditedWhen timestamp, LoadDatetime timestamp",
    )
    lines = spark.createDataFrame(
        [(1, 1, 8, D(2015, 6, 1)), (2, 1, 8, D(2016, 1, 1)), (3, 1, 7, D(2016, 2, 1)), (4, 1, 9, None), (1, 2, None, D(2015, 1, 1))],
        "OrderLineID int, OrderID int, StockItemID int, LastEditedWhen timestamp",
    ).select(
        "*", F.lit("d").alias("Description"), F.lit(1).alias("PackageTypeID"), F.lit(2).alias("Quantity"), F.lit(3).cast("decimal(18,2)").alias("UnitPrice"),
        F.lit(15).cast("decimal(18,3)").alias("TaxRate"), F.col("LastEditedWhen").alias("PickingCompletedWhen"),
    )
    out = facts.order(orders, lines, packages, customers, *dims)
    keys = ["CityKey", "CustomerKey", "StockItemKey", "SalespersonKey", "PickerKey"]
    got = [tuple(r) for r in out.orderBy("OrderKey").select(*keys).collect()]
    assert got == [(1, 5, 8, 3, 4), (1, 5, 8, 3, 4), (101, 105, 0, 103, 104), (1, 5, 9, 3, 4), (0, 0, 0, 0, 0)]
    # Each of the five roles was a sort of all lines by member and time, joined back by the key.
    assert "Window [last(_version" not in _plan(out) and _plan(out).count("Join") <= 1
