"""Change data capture: envelopes to row images to an upserted table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import as_names, epoch_days, epoch_millis
from starloom.operators.dedup import latest_per_key
from starloom.operators.incremental import stamp
from starloom.sources.sinks import merge_into
from starloom.sources.staging import stage
from starloom.sources.tables import ensure_table

# The change-event envelope.
ENVELOPE = """
    payload struct<
        after string,
        before string,
        op string,
        source struct<
            change_lsn string, commit_lsn string, connector string, db string,
            event_serial_no bigint, name string, schema string, sequence string,
            snapshot string, table string, ts_ms bigint, version string>,
        transaction string,
        ts_ms bigint>,
    schema string
"""

# Source column types and the types they become.  Names not listed become string.
TYPE_NAMES = {
    "bigint": "bigint",
    "bit": "boolean",
    "int": "int",
    "smallint": "smallint",
    "tinyint": "smallint",
    "real": "float",
    "float": "double",
    "date": "date",
    "datetime2": "timestamp",
    "datetime": "timestamp",
    "smalldatetime": "timestamp",
    "varbinary": "binary",
    "binary": "binary",
}
DECIMAL_NAMES = ["decimal", "numeric", "money", "smallmoney"]

ORDER_COLUMNS = ["EventTime", "commit_lsn", "change_lsn", "event_serial_no"]
POSITION = "LogPosition"  # a struct of them, which tables written under a guard keep
OPERATIONS = ["c", "u", "r", "d"]  # create, update, snapshot read, delete
MESSAGE, REASON = "_message", "_reason"  # columns of checked changes
REFUSED = f"{MESSAGE} string, {REASON} string, EventTime bigint, commit_lsn string, change_lsn string, event_serial_no bigint"
STREAM_BUCKETS = 8  # of tables that a stream creates


def parse_envelope(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Message to ``payload``, ``op``, ``EventTime`` and the log position; messages without an op go."""
    parsed = df.select(F.from_json(F.col(value_col).cast("string"), ENVELOPE).alias("m"))
    return parsed.select(
        "m.payload",
        "m.payload.op",
        F.col("m.payload.source.ts_ms").alias("EventTime"),
        "m.payload.source.commit_lsn",
        "m.payload.source.change_lsn",
        "m.payload.source.event_serial_no",
    ).where("op IS NOT NULL")


def _image_columns(schema: T.StructType) -> tuple[T.StructType, list[Column]]:
    """The schema of a row image as it is sent, and its columns from ``r`` as they are kept.

    Times arrive as epoch milliseconds and dates as epoch days.
    """
    wire = {"timestamp": T.LongType(), "timestamp_ntz": T.LongType(), "date": T.IntegerType()}
    names = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    sent = T.StructType([T.StructField(f.name, wire.get(t, f.dataType)) for f, (_, t) in zip(schema.fields, names)])
    columns = []
    for name, kind in names:
        value = F.col(f"r.`{name}`")
        if kind.startswith("timestamp"):
            value = epoch_millis(value).cast(kind)
        elif kind == "date":
            value = epoch_days(value)
        columns.append(value.alias(name))
    return sent, columns


def _declared(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def row_image(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The row a change leaves behind (its last state, for a delete), typed by ``schema``.

    Times arrive as epoch milliseconds and dates as epoch days.  An image that
    cannot be read becomes a row of NULLs; ``checked_changes`` sets these apart.
    """
    sent, columns = _image_columns(_declared(schema))
    image = F.when(F.col("op") == "d", F.col("payload.before")).otherwise(F.col("payload.after"))
    return df.withColumn("r", F.from_json(image, sent)).select(*columns, "op", *ORDER_COLUMNS)


def _once(column: Column) -> Column:
    """One row with the value of ``column``, which is computed a single time."""
    return F.explode(F.array(column))


def checked_changes(
    df: DataFrame, schema: T.StructType | str, keys=(), value_col: str = "value", undeclared: str = "ignore"
) -> DataFrame:
    """Every message as a typed row image, with its text in ``_message`` and why it is refused in ``_reason``.

    The reason is NULL for a change that can be applied, else the first of: ``no
    message``, ``envelope not readable``, ``no operation``, ``unknown operation``,
    ``no row image``, ``row image not readable`` (not JSON, cut off, or a value that
    is not of its declared type), ``undeclared column`` (only with
    ``undeclared="refuse"``: the image has a field that ``schema`` lacks), and
    ``no key`` (one of ``keys`` is NULL).  No message is lost: ``accepted`` and
    ``refused`` rows add up to all.
    """
    schema = _declared(schema)
    sent, columns = _image_columns(schema)
    corrupt = {"columnNameOfCorruptRecord": "_unread"}
    message = F.col(value_col).cast("string")
    # A generator is a fence: a filter on the reason is not pushed below it, where each use would parse again.
    parsed = df.select(message.alias(MESSAGE), _once(F.from_json(message, f"{ENVELOPE}, _unread string", corrupt)).alias("m"))
    source = "m.payload.source"
    parsed = parsed.select(
        MESSAGE,
        F.col("m._unread").isNotNull().alias("_torn"),
        F.col("m.payload.op").alias("op"),
        F.when(F.col("m.payload.op") == "d", F.col("m.payload.before")).otherwise(F.col("m.payload.after")).alias("_image"),
        F.col(f"{source}.ts_ms").alias("EventTime"),
        *[F.col(f"{source}.{c}") for c in ORDER_COLUMNS[1:]],
    )
    unread = T.StructType([*sent.fields, T.StructField("_unread", T.StringType())])
    typed = parsed.select("*", _once(F.from_json("_image", unread, corrupt)).alias("r"))
    named = F.array(*[F.lit(f.name) for f in schema.fields])
    strange = F.size(F.array_except(F.coalesce(F.json_object_keys("_image"), F.array().cast("array<string>")), named)) > 0
    reason = (
        F.when(F.col(MESSAGE).isNull() | (F.trim(MESSAGE) == ""), "no message")
        .when(F.col("op").isNull() & F.col("_torn"), "envelope not readable")
        .when(F.col("op").isNull(), "no operation")
        .when(~F.col("op").isin(OPERATIONS), "unknown operation")
        .when(F.col("_image").isNull(), "no row image")
        .when(F.col("r").isNull() | F.col("r._unread").isNotNull(), "row image not readable")
    )
    if undeclared == "refuse":
        reason = reason.when(strange, "undeclared column")
    for key in as_names(keys):
        reason = reason.when(F.col(f"r.`{key}`").isNull(), "no key")
    return typed.select(*columns, "op", *ORDER_COLUMNS, MESSAGE, reason.alias(REASON))


def accepted(checked: DataFrame) -> DataFrame:
    """The changes of ``checked_changes`` that can be applied."""
    return checked.where(F.col(REASON).isNull()).drop(MESSAGE, REASON)


def refused(checked: DataFrame) -> DataFrame:
    """The messages of ``checked_changes`` that cannot be applied, with the reason and what is known of their position."""
    return checked.where(F.col(REASON).isNotNull()).select(MESSAGE, REASON, *ORDER_COLUMNS)


def drop_deletes(df: DataFrame) -> DataFrame:
    return df.where("op <> 'd'")


def latest_images(df: DataFrame, keys) -> DataFrame:
    """The last image of each key: by event time, then by position in the log."""
    return latest_per_key(df, keys, ORDER_COLUMNS)


def changes(df: DataFrame, schema, value_col: str = "value", deletes: str = "ignore") -> DataFrame:
    """Typed row images of a stream or table of messages; messages that cannot be read are left out.

    ``checked_changes`` keeps them, with the reason.
    """
    images = accepted(checked_changes(df, schema, value_col=value_col))
    return drop_deletes(images) if deletes == "ignore" else images


def upsert_batch(
    batch: DataFrame,
    batch_id: int,
    name: str,
    keys,
    root: str | None = None,
    deletes: str = "ignore",
    time_guard: bool = False,
    load_time=None,
    native: bool = False,
    writer: str = "",
    buckets: int | None = None,
    evolve: bool = False,
    refused_to: str | None = None,
) -> None:
    """Merge one micro-batch of row images into the table ``name``.

    A table that a batch creates is kept in ``buckets`` partitions by key,
    ``STREAM_BUCKETS`` by default, and a batch rewrites only those that hold
    one of its keys; ``buckets=0`` keeps whole snapshots.

    ``deletes="apply"`` keeps a tombstone column ``IsDeleted`` instead of
    dropping the change.  ``time_guard`` keeps the columns ``EventTime`` and
    ``LogPosition`` and lets no change overwrite one of a later position in
    the log, be it by event time or, at equal times, by commit, change and serial
    number; the default, like a plain upsert, takes the batches in the order
    they arrive.  ``evolve`` adds columns and widens types the batch has and the
    table lacks.

    Changes that cannot be applied (see ``checked_changes``) and rows without a
    whole key are not merged.  They go to the folder ``refused_path`` gives, under the
    writer and the number of the batch, so a repeated batch replaces its own.
    """
    spark, keys = batch.sparkSession, as_names(keys)
    if REASON not in batch.columns:
        text = F.to_json(F.struct(*[c for c in batch.columns]))
        batch = batch.withColumns({MESSAGE: text, REASON: F.lit(None).cast("string")})
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    batch = batch.withColumn(REASON, F.coalesce(REASON, F.when(keyless, "no key")))
    seen = Observation()
    counted = batch.observe(seen, F.count(REASON).alias("refused"))
    good = accepted(counted)
    latest = latest_images(drop_deletes(good) if deletes == "ignore" else good, keys)
    kept = [c for c in latest.columns if c not in (*ORDER_COLUMNS, "op")]
    extra = [F.col("EventTime"), F.struct(*ORDER_COLUMNS).alias(POSITION)] if time_guard else []
    if deletes == "apply":
        extra.append((F.col("op") == "d").alias("IsDeleted"))
    rows = latest.select(*kept, *extra)
    rows = stamp(rows, load_time) if load_time else rows.withColumn("LoadDatetime", F.current_timestamp())
    # Written once: the merge reads its source several times, the stream should be read once.
    rows = stage(rows, f"batch-{name}")
    if seen.get["refused"]:
        folder = f"{refused_path(spark, name, refused_to)}/writer={writer or 'none'}/batch={batch_id}"
        refused(batch).write.mode("overwrite").parquet(folder)
    # A row that was written without a position gives way.
    later = F.col(f"target.{POSITION}").isNull() | (F.col(f"source.{POSITION}") >= F.col(f"target.{POSITION}"))
    guard = later if time_guard else None
    options = {"guard": guard} if native else {"guard": guard, "check": False}
    if buckets is None and not native and not spark.catalog.tableExists(name):
        buckets = STREAM_BUCKETS
    merge_into(
        spark,
        name,
        rows,
        keys,
        update_cols=rows.columns,
        root=root,
        batch=str(batch_id),
        writer=writer,
        native=native,
        buckets=buckets,
        evolve=evolve,
        **options,
    )


def refused_path(spark: SparkSession, name: str, refused_to: str | None = None) -> str:
    """Folder of the messages refused for a table: ``refused_to``, by default one in the warehouse folder."""
    return refused_to or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/starloom-refused/{name}"


def read_refused(spark: SparkSession, name: str, refused_to: str | None = None) -> DataFrame:
    """Messages refused for a table so far, with their writer and batch; none if no batch had any."""
    path = refused_path(spark, name, refused_to)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], f"{REFUSED}, writer string, batch bigint")
    return spark.read.schema(f"{REFUSED}, writer string, batch bigint").parquet(path)


def upsert_stream(stream: DataFrame, name: str, keys, checkpoint: str, trigger: dict | None = None, **options):
    """Start the query that merges a stream of row images into the table ``name``.

    The rows come from ``changes``, or from ``checked_changes`` to keep refused
    messages.  With ``checkpoint`` on shared storage a restarted query continues
    after the last batch; a batch repeated after a failure is recognised by its
    number and the checkpoint.  Several queries may run at once and write one
    table: their merges take turns (see ``merge_into``), so none loses another's
    rows.  For a key that two of them write, ``time_guard`` lets the later change
    win whichever merges first.  While a batch is merged a reader may see some
    buckets before and some after it.
    """
    writer = _writer(checkpoint)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, name, keys, writer=writer, **options)

    return _start(stream, merge_batch, checkpoint, trigger)


def _writer(checkpoint: str) -> str:
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()


def _start(stream: DataFrame, merge_batch: Callable, checkpoint: str, trigger: dict | None):
    query = stream.writeStream.foreachBatch(merge_batch).outputMode("append").option("checkpointLocation", checkpoint)
    return query.trigger(**(trigger or {"availableNow": True})).start()


def upsert_messages(
    stream: DataFrame,
    name: str,
    declared: Callable[[], DataFrame],
    checkpoint: str,
    table: str | None = None,
    trigger: dict | None = None,
    **options,
):
    """Start the query that merges a stream of messages into ``name`` under the schema in force at each batch.

    ``declared`` returns the rows of ``schema_from_ddl`` as they are by then;
    ``table`` is the name there, by default the last part of ``name``.  A column
    that a later declaration adds is added to the table, and a type that it
    widens is widened; old rows read NULL.  A message that has a field no
    declaration so far names is refused (``undeclared column``) and not cut short, so
    it can be sent again.
    """
    writer = _writer(checkpoint)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        schema, keys = declared_schema(declared(), table or name.split(".")[-1])
        image = T.StructType([f for f in schema.fields if f.name != "LoadDatetime"])
        checked = checked_changes(batch, image, keys, undeclared="refuse")
        upsert_batch(checked, batch_id, name, keys, writer=writer, evolve=True, **options)

    return _start(stream, merge_batch, checkpoint, trigger)


def upsert_streams(
    streams: dict[str, DataFrame],
    schemas: dict[str, T.StructType | str],
    target_schema: str,
    checkpoint_root: str,
    keys: dict[str, list[str]] | None = None,
    **options,
) -> dict:
    """One running query per table: messages of ``streams[name]`` into ``target_schema.name``.

    The key of a table is its first column unless ``keys`` names others.
    ``LoadDatetime`` in a declared schema is the stamp and not part of a message.
    Messages that cannot be applied are kept apart (see ``read_refused``).
    """
    running = {}
    for name, stream in streams.items():
        image = T.StructType([f for f in _declared(schemas[name]).fields if f.name != "LoadDatetime"])
        by = (keys or {}).get(name, [image.fields[0].name])
        running[name] = upsert_stream(
            checked_changes(stream, image, by),
            f"{target_schema}.{name}",
            by,
            f"{checkpoint_root.rstrip('/')}/{name}",
            **options,
        )
    return running


def schema_from_ddl(df: DataFrame, value_col: str = "value") -> DataFrame:
    """The latest declared columns of each table, from a table of DDL-change messages.

    One row per column: table, position, name, Spark type, and whether it is
    part of the primary key.  ``LoadDatetime`` is added as the last column.
    """
    column = "struct<name: string, typeName: string, length: int, scale: int>"
    message = f"""payload struct<
        source: struct<schema: string, table: string, ts_ms: bigint, commit_lsn: string>,
        tableChanges: array<struct<id: string, table: struct<
            primaryKeyColumnNames: array<string>, columns: array<{column}>>>>>"""
    parsed = df.select(F.from_json(F.col(value_col).cast("string"), message).alias("m")).select(
        F.concat_ws("_", "m.payload.source.schema", "m.payload.source.table").alias("named"),
        F.col("m.payload.source.ts_ms").alias("ts_ms"),
        F.col("m.payload.source.commit_lsn").alias("commit_lsn"),
        F.posexplode("m.payload.tableChanges").alias("change", "c"),
    )
    # A change is named by the last two quoted parts of its id, or else by the message's source.
    part = lambda n: F.regexp_extract("c.id", r'"([^"]*)"\."([^"]*)"$', n)
    own = F.when(part(2) != "", F.concat_ws("_", part(1), part(2)))
    parsed = parsed.select(
        F.coalesce(own, "named").alias("table_name"), "ts_ms", "commit_lsn", "change", F.col("c.table").alias("t")
    )
    latest = latest_per_key(parsed.where("t IS NOT NULL"), "table_name", ["ts_ms", "commit_lsn", "change"])
    load = F.struct(
        F.lit("LoadDatetime").alias("name"),
        F.lit("datetime2").alias("typeName"),
        F.lit(None).cast("int").alias("length"),
        F.lit(None).cast("int").alias("scale"),
    )
    rows = latest.select(
        "table_name",
        F.col("t.primaryKeyColumnNames").alias("keys"),
        F.posexplode(F.concat("t.columns", F.array(load.cast(column)))).alias("position", "c"),
    )
    kind = F.col("c.typeName")
    money = F.when(kind == "money", 19).when(kind == "smallmoney", 10)  # fixed precisions, 4 places
    length = F.coalesce("c.length", money, F.lit(18))
    scale = F.coalesce("c.scale", F.when(money.isNotNull(), 4), F.lit(0))
    spark_type = F.when(kind.isin(DECIMAL_NAMES), F.format_string("decimal(%d,%d)", length, scale))
    for source, target in TYPE_NAMES.items():
        spark_type = spark_type.when(kind == source, target)
    return rows.select(
        "table_name",
        F.col("position"),
        F.col("c.name").alias("column_name"),
        spark_type.otherwise("string").alias("spark_type"),
        F.coalesce(F.array_contains("keys", F.col("c.name")), F.lit(False)).alias("is_key"),
    )


def declared_schema(declared: DataFrame, table: str) -> tuple[T.StructType, list[str]]:
    """Schema and key columns of one table from the rows of ``schema_from_ddl``; the first column if no key is declared.

    A table's columns come to the driver.
    """
    rows = declared.where(F.col("table_name") == table).orderBy("position").collect()
    if not rows:
        raise ValueError(f"{table} is not declared")
    schema = T.StructType([T.StructField(r.column_name, T.DataType.fromDDL(r.spark_type)) for r in rows])
    return schema, [r.column_name for r in rows if r.is_key] or [rows[0].column_name]


def create_declared(spark: SparkSession, declared: DataFrame, target_schema: str) -> dict[str, T.StructType]:
    """Create the tables that ``schema_from_ddl`` declares, empty, where they are missing; their schemas.

    These are the schemas ``load_tables`` and ``upsert_streams`` take, so a copy of
    a source needs none but what its log of changes declares.
    """
    made = {}
    for (table,) in declared.select("table_name").distinct().orderBy("table_name").collect():
        made[table], _ = declared_schema(declared, table)
        ensure_table(spark, f"{target_schema}.{table}", made[table])
    return made
