"""Fact loads that break off are resumed from their written copies."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from starloom.plans import loads
from starloom.sources import sinks
from starloom.sources.tables import read_table

D = dt.datetime
KIND = "StockItemID int, QuantityOnHand int, BinLocation string, LastStocktakeQuantity int, LastCostPrice decimal(18,2), " \
    "ReorderLevel int, TargetStockLevel int, LoadDatetime timestamp"  # fmt: skip


def holdings(spark, rows):
    return spark.createDataFrame([(i, q, "L", 1, None, 1, 2, t) for i, q, t in rows], KIND)


@pytest.fixture()
def world(spark, tmp_path):
    schema = f"facts_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    items = spark.range(1, 41).select(
        F.col("id").cast("int").alias("WWIStockItemID"), F.col("id").cast("int").alias("StockItemKey"),
        F.lit(D(2013, 1, 1)).alias("ValidFrom"), F.lit(D(2030, 1, 1)).alias("ValidTo"),
    )
    first = [(i, 10 * i, D(2016, 1, 1)) for i in range(1, 31)]
    second = [(i, 10 * i + 1, D(2017, 1, 1)) for i in range(11, 41)]
    third = [(i, 10 * i + 2, D(2018, 1, 1)) for i in range(1, 41, 2)]
    sources = {"warehouse_stockitemholdings": holdings(spark, first + second + third)}
    options = {"ledger": str(tmp_path / "ledger"), "root": str(tmp_path / "root")}

    def load(to, **more):
        return loads.load_fact(spark, "stock_holding", sources, {"stock_item": items}, schema, to, **options, **more)

    return schema, load, options


def found(df):
    return {r.StockItemKey: (r.StockHoldingKey, r.QuantityOnHand) for r in df.collect()}


@pytest.mark.parametrize("buckets", [None, 8])
def test_a_load_that_breaks_between_buckets_is_resumed(spark, world, monkeypatch, buckets):
    schema, load, options = world
    load(D(2016, 6, 1), buckets=buckets)
    whole, moved = spark.sql, []

    def broken(text, *args, **kw):
        if "SET LOCATION" in text:
            moved.append(text)
            if len(moved) == (3 if buckets else 1):
                raise RuntimeError("lost driver")
        return whole(text, *args, **kw)

    monkeypatch.setattr(spark, "sql", broken)
    monkeypatch.setattr(sinks, "SETTLE_SECONDS", 0.1)
    with pytest.raises(RuntimeError):
        load(D(2017, 6, 1))
    monkeypatch.undo()
    monkeypatch.setattr(sinks, "SETTLE_SECONDS", 0.1)
    (entry,) = loads.open_loads(spark, schema, "fact_stockholding", options["ledger"])
    assert entry["first_key"] == 30 and entry["upto"] == D(2017, 6, 1)
    assert loads.loaded_rows(spark, entry).count() == 30
    got = found(load(D(2018, 6, 1)))
    # items 1 to 30 got keys 0 to 29, items 31 to 40 those behind them, and known rows keep theirs
    assert {i: k for i, (k, _) in got.items()} == {**{i: i - 1 for i in range(1, 31)}, **{i: i + 19 for i in range(31, 41)}}
    assert {i: q for i, (_, q) in got.items()} == {i: 10 * i + (2 if i % 2 else 1 if i > 10 else 0) for i in range(1, 41)}
    states = loads.read_ledger(spark, schema, options["ledger"])
    assert [r.state for r in states.collect()] == ["merged"] * 3
    assert not loads.open_loads(spark, schema, "fact_stockholding", options["ledger"])


def test_a_load_that_breaks_before_its_first_merge(spark, world, monkeypatch):
    schema, load, options = world
    monkeypatch.setattr(loads, "merge_into", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost driver")))
    with pytest.raises(RuntimeError):
        load(D(2016, 6, 1), buckets=4)
    monkeypatch.undo()
    assert not spark.catalog.tableExists(f"{schema}.fact_stockholding")
    got = found(load(D(2017, 6, 1), buckets=4))
    assert len(got) == 40 and sinks.table_property(spark, f"{schema}.fact_stockholding", "starloom.buckets") == "4"
    assert got[1] == (0, 10) and got[11] == (10, 111)


def test_nothing_new_adds_nothing(spark, world):
    schema, load, options = world
    before = found(load(D(2018, 6, 1)))
    assert found(load(D(2018, 6, 1))) == before and loads.read_ledger(spark, "another", options["ledger"]).count() == 2
    assert loads.read_ledger(spark, "x", options["ledger"] + "-none").count() == 0
    with pytest.raises(ValueError):
        loads.load_fact(spark, "customer", {}, {}, schema, D(2018, 1, 1))
    assert read_table(spark, f"{schema}.fact_stockholding").count() == 40
