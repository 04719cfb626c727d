import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.constants import REGULAR_TABLES, TEMPORAL_TABLES
from starloom.operators.checks import (
    StarMismatch,
    ambiguous_names,
    intervals_valid,
    keys_contiguous,
    name_identifies_id,
    star_equal,
    table_diff,
    tables_equal,
)
from starloom.plans import raw_load
from starloom.plans.raw_load import load_table
from starloom.sources import sinks
from starloom.sources.staging import stage, staging_folder
from starloom.sources.tables import (
    empty_table,
    ensure_table,
    extract_columns,
    extract_sql,
    jdbc_options,
    load_schema,
    read_table,
    read_tsv,
)


def name():
    return f"t_{uuid.uuid4().hex}"


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, v string")


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_overwrite_append_read(spark, rows, tmp_path):
    t = name()
    sinks.overwrite(rows, t)
    sinks.append(rows.limit(1), t)
    assert read_table(spark, t).count() == 4
    sinks.overwrite(rows.select(F.lit("x").alias("other")), t)
    assert read_table(spark, t).columns == ["other"]
    path = sinks.overwrite_path(rows, str(tmp_path), "Sales_Orders")
    assert path.endswith("/Sales/Orders") and got(read_table(spark, path)) == got(rows)


def test_merge_into_creates_then_merges(spark, rows, tmp_path):
    t = name()
    sinks.save(rows, t, "merge", ["id"], root=str(tmp_path))
    for n in range(3):  # every snapshot has a folder of its own
        sinks.save(spark.createDataFrame([(1, f"a{n}"), (10 + n, "new")], rows.schema), t, "merge", ["id"], root=str(tmp_path))
    assert got(spark.read.table(t)) == [(1, "a2"), (2, "b"), (3, "c"), (10, "new"), (11, "new"), (12, "new")]
    assert len(list((tmp_path / t).glob("snapshot-*"))) == 4


def test_repeated_batch_is_applied_once(spark, tmp_path):
    t = name()
    start = spark.createDataFrame([(1, 1)], "id int, v int")
    sinks.merge_into(spark, t, start, "id", root=str(tmp_path), batch="0")
    sinks.merge_into(spark, t, start.withColumn("v", F.lit(2)), "id", root=str(tmp_path), batch="1")
    sinks.merge_into(spark, t, start.withColumn("v", F.lit(99)), "id", root=str(tmp_path), batch="1")
    assert got(spark.read.table(t)) == [(1, 2)]


def test_two_writers_do_not_take_each_others_batches_for_repeats(spark, tmp_path):
    t = name()
    for key, writer in ((1, "one"), (2, "two")):
        source = spark.createDataFrame([(key, key)], "id int, v int")
        sinks.merge_into(spark, t, source, "id", root=str(tmp_path), batch="0", writer=writer)
    assert got(spark.read.table(t)) == [(1, 1), (2, 2)]


def test_a_crash_after_repointing_loses_nothing(spark, tmp_path, monkeypatch):
    t = name()
    start = spark.createDataFrame([(1, 1)], "id int, v int")
    sinks.merge_into(spark, t, start, "id", root=str(tmp_path), batch="0")
    whole = spark.sql

    def broken(text, *args, **kw):
        if "TBLPROPERTIES" in text and "ALTER" in text:
            raise RuntimeError("lost driver")
        return whole(text, *args, **kw)

    monkeypatch.setattr(spark, "sql", broken)
    more = spark.createDataFrame([(2, 2)], "id int, v int")
    with pytest.raises(RuntimeError):
        sinks.merge_into(spark, t, more, "id", root=str(tmp_path), batch="1")
    monkeypatch.undo()
    spark.catalog.refreshTable(t)
    sinks.merge_into(spark, t, more, "id", root=str(tmp_path), batch="1")
    assert got(spark.read.table(t)) == [(1, 1), (2, 2)]


def test_merge_leaves_other_buckets_alone(spark, tmp_path):
    t = name()
    start = spark.range(200).select(F.col("id").cast("int").alias("id"), F.lit("a").alias("v"))
    sinks.merge_into(spark, t, start, "id", root=str(tmp_path), buckets=8)
    before = set(spark.read.table(t).inputFiles())
    more = spark.createDataFrame([(3, "b"), (None, "no key"), (None, "no key")], "id long, v string")
    sinks.merge_into(spark, t, more, "id", root=str(tmp_path))
    after = set(spark.read.table(t).inputFiles())
    bucket = lambda files: {f.rsplit("/", 2)[1] for f in files}
    assert len(bucket(before)) == 8 and len(bucket(before - after)) == 1
    assert bucket(after - before) == bucket(before - after) | {"starloom_bucket=-1"}
    out = read_table(spark, t)
    assert out.columns == ["id", "v"] and out.count() == 202
    assert got(out.where("v <> 'a'").fillna(-1)) == [(-1, "no key"), (-1, "no key"), (3, "b")]
    with pytest.raises(ValueError):
        sinks.merge_into(spark, t, more, "id", root=str(tmp_path), buckets=4)


def test_a_bucket_merge_that_broke_off_is_repeated(spark, tmp_path, monkeypatch):
    t = name()
    start = spark.range(50).select("id", F.lit(0).alias("v"))
    sinks.merge_into(spark, t, start, "id", root=str(tmp_path), buckets=4, batch="0")
    whole, moved = spark.sql, []

    def broken(text, *args, **kw):
        if "SET LOCATION" in text:
            moved.append(text)
            if len(moved) == 3:
                raise RuntimeError("lost driver")
        return whole(text, *args, **kw)

    monkeypatch.setattr(spark, "sql", broken)
    more = spark.range(25, 75).select("id", F.lit(1).alias("v"))
    with pytest.raises(RuntimeError):
        sinks.merge_into(spark, t, more, "id", root=str(tmp_path), batch="1")
    monkeypatch.undo()
    sinks.merge_into(spark, t, more, "id", root=str(tmp_path), batch="1")
    assert got(read_table(spark, t)) == [(k, int(k >= 25)) for k in range(75)]


def test_a_bucket_merge_of_nothing_creates_an_empty_table(spark, rows, tmp_path):
    t = name()
    sinks.merge_into(spark, t, rows.where("false"), "id", root=str(tmp_path), buckets=4)
    assert got(read_table(spark, t)) == []
    sinks.merge_into(spark, t, rows, "id", root=str(tmp_path), check=False)
    assert got(read_table(spark, t)) == got(rows)


def test_a_guard_is_refused_where_it_would_be_dropped(spark, rows):
    with pytest.raises(ValueError):
        sinks.merge_into(spark, name(), rows, "id", native=True, guard=F.lit(True))


def test_unknown_modes_are_refused(rows):
    with pytest.raises(sinks.UnsupportedSaveMode):
        sinks.save(rows, name(), "upsert")
    with pytest.raises(sinks.UnsupportedSaveMode):
        sinks.write_external(rows, "jdbc", {}, "merge")


def test_warehouse_presets():
    fmt, options = sinks.warehouse_options("sqlserver", "dimension_city", url="jdbc:x", user="u", password="p")
    assert fmt == "jdbc" and options["dbtable"] == "Dimension.dimension_city" and options["url"] == "jdbc:x;user=u;password=p"
    fmt, options = sinks.warehouse_options("synapse", "fact_sale", url="x", user="u", password="p", temp_dir="d")
    assert options["dbtable"] == "Fact.fact_sale" and options["tempDir"] == "d" and options["useAzureMSI"] == "true"
    fmt, options = sinks.warehouse_options("snowflake", "fact_sale", url="x", user="u", password="p", database="d", warehouse="w")
    assert fmt == "snowflake" and options["sfSchema"] == "FACT" and options["dbtable"] == "FACT_SALE"


def test_sample_export_round_trip(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").cast("int"), F.when(F.col("id") % 2 == 0, "").otherwise("t\tab\n").alias("v"))
    path = str(tmp_path / "sample")
    sinks.export_sample(df.repartition(5), path, "id", 10)
    assert len(list((tmp_path / "sample").glob("part-*"))) == 1
    back = read_tsv(spark, path, df.schema).collect()
    # as usual for this format, an empty text is read as NULL
    assert [(r.id, r.v) for r in back] == [(i, None if i % 2 == 0 else "t\tab\n") for i in range(10)]


def test_samples_of_several_tables(spark, tmp_path):
    cities = spark.range(50).selectExpr("50 - id AS CityID", "'x' AS CityName")
    people = spark.range(9).selectExpr("id AS PersonID", "id % 2 = 0 AS IsPermittedToLogon")
    sinks.export_samples({"Application_Cities": cities, "Application_People": people}, str(tmp_path), 3)
    read = read_tsv(spark, str(tmp_path / "Application" / "Cities"), "CityID bigint, CityName string")
    assert [r.CityID for r in read.collect()] == [1, 2, 3]
    read = read_tsv(spark, str(tmp_path / "Application" / "People"), "PersonID bigint, IsPermittedToLogon boolean")
    assert [r.PersonID for r in read.collect()] == [1, 3, 5]


def test_sample_export_plan_keeps_first_rows_per_task(spark):
    plan = spark.range(1000).orderBy("id").limit(10).coalesce(1)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_tsv_types_and_offsets(spark, tmp_path):
    (tmp_path / "x.tsv").write_text('id\tname\tfrom\n1\t"two\nlines"\t2013-01-01T02:00:00.000+02:00\n2\t""\t\n')
    out = read_tsv(spark, str(tmp_path / "x.tsv"), "id int, name string, from timestamp").collect()
    assert out[0].name == "two\nlines" and out[0]["from"] == dt.datetime(2013, 1, 1)
    assert out[1]["from"] is None


def test_schema_file_and_empty_table(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("LoadDatetime", T.TimestampType(), False)])
    (tmp_path / "s.json").write_text(json.dumps(schema.jsonValue()))
    read = load_schema(str(tmp_path / "s.json"))
    assert read == schema and empty_table(spark, read).schema == schema
    t = name()
    assert ensure_table(spark, t, schema).count() == 0
    assert ensure_table(spark, t, schema).columns == ["id", "LoadDatetime"]


def test_extract(spark, rows):
    assert extract_columns(rows, ["id"], as_text=["id"]).schema["id"].dataType == T.StringType()
    assert extract_sql("Sales_Orders", ["OrderID", "CustomerID"]) == "SELECT OrderID, CustomerID FROM Sales.Orders"
    text = extract_sql("Application_Cities", ["CityID", "Location"], archive=True)
    assert text == "SELECT CityID, CAST(Location AS varchar(max)) AS Location FROM Application.Cities_Archive"
    assert len(REGULAR_TABLES) == 11 and len(TEMPORAL_TABLES) == 17


def test_jdbc_options():
    assert jdbc_options("u", "SELECT 1", "d") == {"url": "u", "driver": "d", "query": "SELECT 1"}
    split = {"column": "OrderID", "lower": 1, "upper": 100, "partitions": 8}
    options = jdbc_options("u", "SELECT 1", split=split, fetchsize="1000")
    assert options["dbtable"] == "(SELECT 1) src" and "query" not in options
    assert options["partitionColumn"] == "OrderID" and options["numPartitions"] == "8" and options["fetchsize"] == "1000"


@pytest.mark.parametrize("table,buckets", [("Sales_Orders", None), ("Application_Cities", None), ("Application_Cities", 4)])
def test_raw_load_of_both_kinds(spark, tmp_path, table, buckets):
    schema = f"raw_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    time = "LastEditedWhen timestamp" if table == "Sales_Orders" else "ValidFrom timestamp, ValidTo timestamp"
    declared = T.StructType.fromDDL(f"id int, v string, {time}, LoadDatetime timestamp")

    def d(n):
        return dt.datetime(2020, 1, n)

    def source(stage_):
        if table == "Sales_Orders":
            data = [(1, "a", d(1)), (2, "b", d(2))] if stage_ == 1 else [(1, "a2", d(8)), (2, "b", d(2)), (3, "c", d(9))]
            return lambda sql: spark.createDataFrame(data, "id int, v string, LastEditedWhen timestamp")
        now = [(1, "a", d(1), d(31))] if stage_ == 1 else [(1, "b", d(8), d(31))]
        old = [] if stage_ == 1 else [(1, "a", d(1), d(8))]
        return lambda sql: spark.createDataFrame(old if "_Archive" in sql else now, "id int, v string, ValidFrom timestamp, ValidTo timestamp")

    load_table(spark, table, declared, d(5), source(1), schema, root=str(tmp_path), buckets=buckets)
    load_table(spark, table, declared, d(10), source(2), schema, root=str(tmp_path), buckets=buckets)
    out = sorted((r.id, r.v, r.LoadDatetime) for r in spark.read.table(f"{schema}.{table}").collect())
    if table == "Sales_Orders":
        assert out == [(1, "a2", d(10)), (2, "b", d(5)), (3, "c", d(10))]
    else:
        assert out == [(1, "a", d(5)), (1, "b", d(10))]


def test_raw_load_takes_schemas_from_a_folder_and_splits_reads(spark, tmp_path, monkeypatch):
    declared = T.StructType.fromDDL("OrderID int, LastEditedWhen timestamp, LoadDatetime timestamp")
    (tmp_path / "regular").mkdir()
    (tmp_path / "regular" / "Sales_Orders.json").write_text(json.dumps(declared.jsonValue()))
    schema, asked = f"raw_{uuid.uuid4().hex}", []
    spark.sql(f"CREATE DATABASE {schema}")

    def read(spark, url, sql, split=None):
        asked.append((url, sql, split))
        return spark.createDataFrame([(1, dt.datetime(2020, 1, 1))], "OrderID int, LastEditedWhen timestamp")

    monkeypatch.setattr(raw_load, "read_jdbc", read)
    split = {"column": "OrderID", "lower": 1, "upper": 9, "partitions": 2}
    raw_load.load_tables(
        spark, "url", str(tmp_path), dt.datetime(2020, 1, 5), schema, {"Sales_Orders": split}, root=str(tmp_path / "t")
    )
    assert asked == [("url", "SELECT OrderID, LastEditedWhen FROM Sales.Orders", split)]
    assert spark.read.table(f"{schema}.Sales_Orders").count() == 1


def test_stage_uses_the_shared_folder(spark, rows):
    assert staging_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    staged = stage(rows, "x")
    assert got(staged) == got(rows) and staging_folder(spark) in staged.inputFiles()[0]


def test_checks(spark, rows):
    assert tables_equal(rows, rows.orderBy("id")) and not tables_equal(rows, rows.union(rows.limit(1)))
    diff = table_diff(rows, rows.where("id < 3").union(rows.where("id = 1"))).collect()
    assert {(r.only_in, r.copies, r.id) for r in diff} == {("actual", 1, 3), ("expected", 1, 1)}
    nulls = spark.createDataFrame([(None, "x")], rows.schema)
    assert tables_equal(nulls, nulls)
    assert star_equal({"a": rows, "b": rows}, {"a": rows})
    with pytest.raises(StarMismatch, match="b"):
        star_equal({"a": rows, "b": rows}, {"a": rows, "b": nulls})
    keys = spark.range(5)
    assert keys_contiguous(keys, "id") and not keys_contiguous(keys.where("id <> 2"), "id")
    assert not keys_contiguous(keys.union(keys), "id") and not keys_contiguous(keys, "id", first=1)
    names = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "b")], "id int, n string")
    assert not name_identifies_id(names, "id", "n")
    assert [(r.n, r.n_ids) for r in ambiguous_names(names, "id", "n").collect()] == [("b", 2)]
    spans = spark.createDataFrame([(dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 1))], "ValidFrom timestamp, ValidTo timestamp")
    assert not intervals_valid(spans) and intervals_valid(spans.where("false"))
