"""Merges into one table by several writers, and tables that take new columns and wider types."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.merge import merge_upsert
from starloom.sources import sinks
from starloom.sources.tables import read_table


@pytest.fixture()
def name():
    return f"t_{uuid.uuid4().hex}"


def rows(spark, *pairs, kind="id int, v string"):
    return spark.createDataFrame(list(pairs), kind)


def got(spark, name):
    return sorted(tuple(r) for r in read_table(spark, name).collect())


@pytest.mark.parametrize("buckets", [None, 1, 4])
def test_four_threads_keep_all_keys(spark, tmp_path, name, buckets):
    sinks.merge_into(spark, name, rows(spark, (0, "old")), "id", root=str(tmp_path), buckets=buckets)
    wrong = []

    def merge(n):
        try:
            for again in range(2):
                sinks.merge_into(spark, name, rows(spark, (n, f"{n} {again}"), (0, "shared")), "id", root=str(tmp_path))
        except Exception as e:  # noqa: BLE001
            wrong.append(e)

    threads = [threading.Thread(target=merge, args=(n,)) for n in range(1, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not wrong
    assert got(spark, name) == [(0, "shared"), *[(n, f"{n} 1") for n in range(1, 5)]]


@pytest.mark.parametrize("buckets", [None, 2])
def test_creating_threads_keep_all_keys(spark, tmp_path, name, buckets):
    threads = [
        threading.Thread(target=sinks.merge_into, args=(spark, name, rows(spark, (n, "v")), "id"), kwargs={"root": str(tmp_path), "buckets": buckets})
        for n in range(3)
    ]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert got(spark, name) == [(n, "v") for n in range(3)]


@pytest.mark.parametrize("buckets", [None, 2])
def test_a_writer_of_another_driver_is_noticed(spark, tmp_path, name, buckets, monkeypatch):
    sinks.merge_into(spark, name, rows(spark, (0, "old"), (9, "nine")), "id", root=str(tmp_path), buckets=buckets)
    others = [rows(spark, (1, "other"), (0, "theirs")), rows(spark, (2, "other"), (9, "again"))]

    def slow(target, source, keys, *args, **options):
        # The lock lets its own thread in again, as no lock keeps another driver out.
        mine = merge_upsert(target, source, keys, *args, **options)
        if others:
            sinks.merge_into(spark, name, others.pop(), "id", root=str(tmp_path))
        return mine

    monkeypatch.setattr(sinks, "merge_upsert", slow)
    sinks.merge_into(spark, name, rows(spark, (0, "mine"), (3, "mine")), "id", root=str(tmp_path))
    assert got(spark, name) == [(0, "mine"), (1, "other"), (2, "other"), (3, "mine"), (9, "again")]


def test_a_table_that_never_rests_raises(spark, tmp_path, name, monkeypatch):
    sinks.merge_into(spark, name, rows(spark, (0, "old")), "id", root=str(tmp_path))
    turns = iter(range(100))

    def never(target, source, *args, **options):
        sinks.replace_snapshot(spark, name, rows(spark, (0, f"turn {next(turns)}")), str(tmp_path))
        return merge_upsert(target, source, *args, **options)

    monkeypatch.setattr(sinks, "merge_upsert", never)
    monkeypatch.setattr(sinks, "MERGE_ATTEMPTS", 3)
    with pytest.raises(sinks.ConcurrentMerge):
        sinks.merge_into(spark, name, rows(spark, (5, "mine")), "id", root=str(tmp_path))
    assert got(spark, name) == [(0, "turn 2")]


def test_a_dead_writer_is_waited_for_and_passed(spark, tmp_path, name, monkeypatch):
    monkeypatch.setattr(sinks, "SETTLE_SECONDS", 0.5)
    sinks.merge_into(spark, name, rows(spark, (0, "old")), "id", root=str(tmp_path), buckets=2)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('starloom.version'='x:open')")
    sinks.merge_into(spark, name, rows(spark, (1, "new")), "id", root=str(tmp_path))
    assert got(spark, name) == [(0, "old"), (1, "new")]
    assert not sinks.table_state(spark, name)[1].endswith(":open")


@pytest.mark.parametrize("buckets", [None, 3])
def test_new_columns_and_wider_types(spark, tmp_path, name, buckets):
    options = {"root": str(tmp_path), "writer": "w"}
    sinks.merge_into(spark, name, rows(spark, (1, "a"), (2, "b")), "id", buckets=buckets, batch="0", **options)
    added = rows(spark, (2, "b2", 1.5), (3, "c", 2.5), kind="id int, v string, price float")
    sinks.merge_into(spark, name, added, "id", batch="1", evolve=True, **options)
    assert got(spark, name) == [(1, "a", None), (2, "b2", 1.5), (3, "c", 2.5)]
    wide = rows(spark, (1 << 40, 0.1), (1, 0.2), kind="id long, price double")
    sinks.merge_into(spark, name, wide, "id", batch="2", evolve=True, **options)
    assert got(spark, name) == [(1, "a", 0.2), (2, "b2", 1.5), (3, "c", 2.5), (1 << 40, None, 0.1)]
    # the marks of writers and the buckets are still there
    sinks.merge_into(spark, name, rows(spark, (7, "not again")), "id", batch="2", evolve=True, **options)
    assert len(got(spark, name)) == 4
    assert sinks.table_property(spark, name, "starloom.buckets") == (str(buckets) if buckets else None)
    sinks.merge_into(spark, name, rows(spark, (7, "narrow")), "id", batch="3", evolve=True, **options)
    assert (7, "narrow", None) in got(spark, name)


def test_wider_types():
    kind = T.DataType.fromDDL
    cases = [
        ("int", "bigint", "bigint"), ("smallint", "tinyint", "smallint"), ("float", "double", "double"), ("int", "decimal(4,2)", "decimal(12,2)"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("date", "timestamp", "timestamp"), ("timestamp_ntz", "date", "timestamp_ntz"),
        ("boolean", "string", "string"), ("string", "string", "string"),
    ]
    for a, b, wide in cases:
        assert sinks.wider_type(kind(a), kind(b)) == sinks.wider_type(kind(b), kind(a)) == kind(wide)
    for a, b in [("binary", "string"), ("boolean", "int"), ("decimal(38,0)", "decimal(38,2)"), ("struct<a:int>", "string")]:
        with pytest.raises(ValueError):
            sinks.wider_type(kind(a), kind(b))


def test_nothing_to_evolve_changes_nothing(spark, tmp_path, name):
    sinks.merge_into(spark, name, rows(spark, (1, "a")), "id", root=str(tmp_path))
    before = sinks.table_state(spark, name)
    assert sinks.evolve_table(spark, name, read_table(spark, name).schema, str(tmp_path)) == []
    assert sinks.table_state(spark, name) == before
    assert sinks.table_state(spark, "no_such_table") is None
    assert read_table(spark, name).where(F.col("v") == "a").count() == 1
