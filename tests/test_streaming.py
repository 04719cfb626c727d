import datetime as dt
import json
import uuid

from starloom.sources.changes import event_hub_name, event_hubs_options, kafka_options, read_changes
from starloom.sources.tables import read_table
from starloom.streaming.cdc import (
    accepted,
    changes,
    checked_changes,
    create_declared,
    declared_schema,
    latest_images,
    parse_envelope,
    read_refused,
    refused,
    row_image,
    schema_from_ddl,
    upsert_batch,
    upsert_messages,
    upsert_stream,
    upsert_streams,
)

ROW = "id int, name string, price decimal(18,2), at timestamp, day date"
MS = 1_577_836_800_123  # 2020-01-01 00:00:00.123


def message(op, ts, row, lsn="0", serial=0, before=None):
    source = {"ts_ms": ts, "commit_lsn": lsn, "change_lsn": lsn, "event_serial_no": serial, "table": "t", "schema": "s"}
    payload = {
        "op": op,
        "source": source,
        "after": json.dumps(row) if row else None,
        "before": json.dumps(before) if before else None,
        "ts_ms": ts,
    }
    return json.dumps({"payload": payload})


def image(i, name):
    return {"id": i, "name": name, "price": 12.5, "at": MS, "day": 18262}


def messages(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_envelope_and_row_image(spark):
    df = messages(spark, [message("c", 5, image(1, "a")), message(None, 6, image(2, "b")), message("d", 7, None, before=image(3, "z")), "{}"])
    rows = row_image(parse_envelope(df), ROW).orderBy("id").collect()
    assert [(r.id, r.name, r.op, r.EventTime) for r in rows] == [(1, "a", "c", 5), (3, "z", "d", 7)]
    assert float(rows[0].price) == 12.5
    assert rows[0].at == dt.datetime(2020, 1, 1, 0, 0, 0, 123_000)
    assert rows[0].day == dt.date(2020, 1, 1)
    assert [r.id for r in changes(df, ROW).collect()] == [1]
    binary = df.selectExpr("CAST(value AS binary) AS value")
    assert changes(binary, ROW, deletes="apply").count() == 2


def test_latest_image_breaks_ties_by_log_position(spark):
    df = messages(
        spark,
        [
            message("c", 5, image(1, "first"), "01"),
            message("u", 5, image(1, "second"), "02", 1),
            message("u", 5, image(1, "third"), "02", 2),
            message("u", 4, image(1, "earlier"), "09"),
        ],
    )
    assert [r.name for r in latest_images(changes(df, ROW), "id").collect()] == ["third"]


def run_stream(spark, folder, name, checkpoint, root, deletes="ignore", **options):
    stream = read_changes(spark, "text", {"maxFilesPerTrigger": "1"}, path=str(folder))
    q = upsert_stream(changes(stream, ROW, deletes=deletes), name, "id", str(checkpoint), root=str(root), deletes=deletes, **options)
    q.awaitTermination()
    return read_table(spark, name)


def write(folder, number, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"part-{number}.txt").write_text("\n".join(rows))


def test_stream_upsert_and_restart(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    folder = tmp_path / "in"
    write(folder, 1, [message("c", 1, image(1, "a")), message("c", 1, image(2, "b")), message("u", 2, image(1, "a2"))])
    table = run_stream(spark, folder, name, tmp_path / "cp", tmp_path / "root")
    assert {(r.id, r.name) for r in table.collect()} == {(1, "a2"), (2, "b")}
    write(folder, 2, [message("u", 3, image(2, "b2")), message("d", 4, None, before=image(1, "a2")), message("c", 3, image(3, "c"))])
    table = run_stream(spark, folder, name, tmp_path / "cp", tmp_path / "root")
    assert {(r.id, r.name) for r in table.collect()} == {(1, "a2"), (2, "b2"), (3, "c")}
    # nothing new: the restarted query changes nothing
    again = run_stream(spark, folder, name, tmp_path / "cp", tmp_path / "root")
    assert again.count() == 3


def test_late_event_of_a_later_batch(spark, tmp_path):
    for guard, expected in ((False, "late"), (True, "new")):
        name, base = f"t_{uuid.uuid4().hex}", tmp_path / str(guard)
        base.mkdir()
        write(base / "in", 1, [message("c", 10, image(1, "new"))])
        run_stream(spark, base / "in", name, base / "cp", base / "root", time_guard=guard)
        write(base / "in", 2, [message("u", 5, image(1, "late"))])
        table = run_stream(spark, base / "in", name, base / "cp", base / "root", time_guard=guard)
        assert [r.name for r in table.collect()] == [expected]


def test_deletes_can_be_kept_as_tombstones(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    write(tmp_path / "in", 1, [message("c", 1, image(1, "a")), message("c", 1, image(2, "b")), message("d", 2, None, before=image(1, "a"))])
    table = run_stream(spark, tmp_path / "in", name, tmp_path / "cp", tmp_path / "root", deletes="apply")
    assert {(r.id, r.IsDeleted) for r in table.collect()} == {(1, True), (2, False)}


def test_one_query_per_table(spark, tmp_path):
    schema = f"cdc_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    streams = {}
    for table, who in (("Sales_Orders", "a"), ("Application_Cities", "b")):
        write(tmp_path / table, 1, [message("c", 1, image(1, who)), message("u", 2, image(1, who * 2))])
        streams[table] = read_changes(spark, "text", {}, path=str(tmp_path / table))
    schemas = dict.fromkeys(streams, f"{ROW}, LoadDatetime timestamp")
    running = upsert_streams(streams, schemas, schema, str(tmp_path / "cp"), root=str(tmp_path / "root"))
    for q in running.values():
        q.awaitTermination()
    assert [r.name for r in read_table(spark, f"{schema}.Sales_Orders").collect()] == ["aa"]
    assert read_table(spark, f"{schema}.Application_Cities").columns == ["id", "name", "price", "at", "day", "LoadDatetime"]


def test_schema_from_ddl(spark):
    def ddl(ts, columns, keys=("Id",)):
        table = {"primaryKeyColumnNames": list(keys), "columns": columns}
        source = {"schema": "Sales", "table": "Orders", "ts_ms": ts, "commit_lsn": "1"}
        return json.dumps({"payload": {"source": source, "tableChanges": [{"table": table}]}})

    kinds = [
        ("Id", "int", "int"), ("a", "bigint", "bigint"), ("b", "bit", "boolean"), ("c", "decimal", "decimal(18,2)"),
        ("d", "money", "decimal(18,2)"), ("e", "smallint", "smallint"), ("f", "real", "float"), ("g", "float", "double"),
        ("h", "date", "date"), ("i", "datetime2", "timestamp"), ("j", "datetimeoffset", "string"),
        ("k", "nvarchar", "string"), ("l", "varbinary", "binary"), ("m", "geography", "string"), ("n", "hierarchyid", "string"),
    ]
    columns = [{"name": n, "typeName": t, "length": 18, "scale": 2} for n, t, _ in kinds]
    rows = schema_from_ddl(messages(spark, [ddl(1, columns[:2]), ddl(2, columns)])).orderBy("position").collect()
    assert [(r.column_name, r.spark_type) for r in rows] == [(n, s) for n, _, s in kinds] + [("LoadDatetime", "timestamp")]
    assert [r.column_name for r in rows if r.is_key] == ["Id"]
    assert {r.table_name for r in rows} == {"Sales_Orders"}
    # the declared types are types Spark knows
    spark.createDataFrame([], ", ".join(f"`{r.column_name}` {r.spark_type}" for r in rows))


def test_stream_presets():
    assert kafka_options("h:9092", "Sales_Orders")["subscribe"] == "WWI.Sales.Orders"
    assert kafka_options("h:9092", "")["subscribe"] == "WWI"
    assert kafka_options("h:9092", "x")["startingOffsets"] == "earliest"
    assert event_hub_name("Sales_Orders") == "cdc.Sales.Orders" and event_hub_name("") == "cdc"
    assert json.loads(event_hubs_options("c", "g")["eventhubs.startingPosition"])["offset"] == -1


def test_late_change_at_an_equal_time(spark, tmp_path):
    for buckets in (None, 0):
        name, base = f"t_{uuid.uuid4().hex}", tmp_path / str(buckets)
        base.mkdir()
        write(base / "in", 1, [message("c", 10, image(1, "new"), "09", 1), message("c", 10, image(2, "first"), "03")])
        run_stream(spark, base / "in", name, base / "cp", base / "root", time_guard=True, buckets=buckets)
        write(base / "in", 2, [message("u", 10, image(1, "late"), "03", 7), message("u", 10, image(2, "second"), "03", 1)])
        table = run_stream(spark, base / "in", name, base / "cp", base / "root", time_guard=True)
        assert {r.id: (r.name, r.LogPosition.commit_lsn) for r in table.collect()} == {1: ("new", "09"), 2: ("second", "03")}


def test_every_message_is_accepted_or_refused(spark):
    whole = message("c", 5, image(1, "a"))
    cut = json.loads(message("u", 6, image(2, "b")))
    cut["payload"]["after"] = cut["payload"]["after"][:-4]
    wrong = message("c", 7, {**image(3, "c"), "day": "not a day"})
    more = message("c", 7, {**image(4, "c"), "extra": 1})
    rows = {
        whole: None, json.dumps(cut): "row image not readable", wrong: "row image not readable", more: None, "{": "envelope not readable",
        "{}": "no operation", message("t", 1, None): "unknown operation", message("c", 1, None): "no row image", "": "no message",
        message("d", 8, None, before={"name": "x"}): "no key", message("c", 8, {"id": None, "name": "x"}): "no key",
    }
    checked = checked_changes(messages(spark, list(rows)), ROW, "id")
    assert {r._message: r._reason for r in checked.collect()} == rows
    assert accepted(checked).count() + refused(checked).count() == len(rows)
    assert sorted(r.id for r in changes(messages(spark, list(rows)), ROW).collect() if r.id) == [1, 4]
    strict = checked_changes(messages(spark, [whole, more]), ROW, "id", undeclared="refuse")
    assert sorted(r._reason or "" for r in strict.collect()) == ["", "undeclared column"]


def test_refused_messages_are_kept_once(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    rows = [message("c", 1, image(1, "a")), message("c", 2, {"name": "no key"}), message("c", 3, {"name": "none either"}), "{"]
    checked = checked_changes(messages(spark, rows), ROW, "id")
    for _ in range(2):  # the second time as after a crash between writing and the checkpoint
        upsert_batch(checked, 0, name, "id", root=str(tmp_path / "r"), writer="w", refused_to=str(tmp_path / "no"))
    upsert_batch(checked, 1, name, "id", root=str(tmp_path / "r"), writer="w", refused_to=str(tmp_path / "no"))
    assert read_table(spark, name).count() == 1
    kept = read_refused(spark, name, str(tmp_path / "no"))
    assert sorted((r.batch, r._reason) for r in kept.collect()) == sorted((b, r) for b in (0, 1) for r in ("no key", "no key", "envelope not readable"))
    # typed rows without a key, from a stream that does not check, are kept as well
    plain = accepted(checked_changes(messages(spark, rows), ROW))
    other = f"t_{uuid.uuid4().hex}"
    upsert_batch(plain, 0, other, "id", root=str(tmp_path / "r"), refused_to=str(tmp_path / "no2"))
    assert read_table(spark, other).count() == 1 and read_refused(spark, other, str(tmp_path / "no2")).count() == 2
    assert read_refused(spark, other, str(tmp_path / "never")).count() == 0


def test_streams_that_run_at_once_keep_each_others_rows(spark, tmp_path):
    for buckets in (3, 0):
        name, running = f"t_{uuid.uuid4().hex}", []
        for part in range(3):
            folder = tmp_path / f"in-{buckets}-{part}"
            for n in range(2):
                write(folder, n, [message("c", 1, image(10 * part + n, f"{part}{n}")), message("u", part + 2, image(99, f"shared {part}"))])
            stream = read_changes(spark, "text", {"maxFilesPerTrigger": "1"}, path=str(folder))
            options = {"root": str(tmp_path / "root"), "time_guard": True, "buckets": buckets}
            running.append(upsert_stream(changes(stream, ROW), name, "id", f"{folder}-cp", **options))
        for q in running:
            q.awaitTermination()
        got = {r.id: r.name for r in read_table(spark, name).collect()}
        assert got == {**{10 * p + n: f"{p}{n}" for p in range(3) for n in range(2)}, 99: "shared 2"}


def declaration(ts, columns, table="T", keys=("id",)):
    listed = [{"name": n, "typeName": t, "length": 18, "scale": 2} for n, t in columns]
    change = {"id": f'"wide"."S"."{table}"', "table": {"primaryKeyColumnNames": list(keys), "columns": listed}}
    return json.dumps({"payload": {"source": {"schema": "S", "table": table, "ts_ms": ts, "commit_lsn": "1"}, "tableChanges": [change]}})


def test_table_follows_the_declared_schema(spark, tmp_path):
    for buckets in (None, 0):
        name, base = f"t_{uuid.uuid4().hex}", tmp_path / str(buckets)
        base.mkdir()

        def run(buckets=None):
            query = upsert_messages(
                read_changes(spark, "text", {}, path=str(base / "in")),
                name,
                lambda: schema_from_ddl(spark.read.text(str(base / "ddl"))),
                str(base / "cp"),
                table="S_T",
                root=str(base / "root"),
                buckets=buckets,
                refused_to=str(base / "no"),
            )
            query.awaitTermination()
            return {r.id: r for r in read_table(spark, name).collect()}

        write(base / "ddl", 1, [declaration(1, [("id", "int"), ("a", "smallint")])])
        write(base / "in", 1, [message("c", 1, {"id": 1, "a": 7}), message("c", 1, {"id": 2, "a": 8, "b": "early"})])
        assert set(run(buckets)) == {1}
        assert [r._reason for r in read_refused(spark, name, str(base / "no")).collect()] == ["undeclared column"]
        write(base / "ddl", 2, [declaration(2, [("id", "bigint"), ("a", "decimal"), ("b", "nvarchar")])])
        write(base / "in", 2, [message("c", 2, {"id": 1 << 40, "a": 1.25, "b": "x"}), message("u", 3, {"id": 2, "a": 9, "b": "y"})])
        rows = run()
        assert {k: (str(r.a), r.b) for k, r in rows.items()} == {1: ("7.00", None), 1 << 40: ("1.25", "x"), 2: ("9.00", "y")}
        kinds = dict(read_table(spark, name).dtypes)
        assert (kinds["id"], kinds["a"], kinds["b"]) == ("bigint", "decimal(18,2)", "string")
        # a declaration without a column leaves it alone
        write(base / "ddl", 3, [declaration(3, [("id", "bigint"), ("b", "nvarchar")])])
        write(base / "in", 3, [message("u", 4, {"id": 1, "b": "z"})])
        rows = run()
        assert (str(rows[1].a), rows[1].b, len(rows)) == ("7.00", "z", 3)


def test_declared_tables_are_created_empty(spark):
    schema = f"raw_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    log = [declaration(1, [("id", "int")], "A"), declaration(2, [("id", "int"), ("at", "datetime2")], "A"), declaration(1, [("k", "bit")], "B", ())]
    declared = schema_from_ddl(messages(spark, log))
    made = create_declared(spark, declared, schema)
    assert {k: v.simpleString() for k, v in made.items()} == {
        "S_A": "struct<id:int,at:timestamp,LoadDatetime:timestamp>",
        "S_B": "struct<k:boolean,LoadDatetime:timestamp>",
    }
    assert read_table(spark, f"{schema}.S_A").count() == 0
    create_declared(spark, declared, schema)
    assert declared_schema(declared, "S_B")[1] == ["k"]
