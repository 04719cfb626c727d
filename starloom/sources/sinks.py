"""Table, JDBC and external warehouse sinks."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.constants import SAMPLE_ORDER
from starloom.operators.merge import merge_upsert
from starloom.sources.staging import SMALL, no_shuffle_left
from starloom.sources.tables import BUCKET, read_table

_BATCH = "starloom.batch"
_BUCKETS = "starloom.buckets"
_KEYS = "starloom.keys"  # whose hash gives the bucket
_VERSION = "starloom.version"  # changes with every merge; ends with _OPEN while partitions are repointed
_OPEN = ":open"
MERGE_ATTEMPTS = 20  # merges begun anew because a writer outside this driver was faster
SETTLE_SECONDS = 30.0  # wait for such a writer to finish repointing; after that it is taken for dead

_ANY = object()  # any state of a table will do

_locks: dict[str, threading.RLock] = {}
_locks_guard = threading.Lock()


class UnsupportedSaveMode(Exception):
    """The sink cannot save that way."""


class ConcurrentMerge(Exception):
    """The table changed while its new contents were computed."""


def overwrite(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Replace data and schema of a catalog table."""
    with no_shuffle_left(df.sparkSession):
        df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def table_path(root: str, table: str) -> str:
    """``Schema_Table`` is kept in ``root/Schema/Table``."""
    return f"{root.rstrip('/')}/{table.replace('_', '/')}"


def overwrite_path(df: DataFrame, root: str, table: str, fmt: str = "parquet") -> str:
    path = table_path(root, table)
    df.write.format(fmt).mode("overwrite").save(path)
    return path


def append(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").saveAsTable(name)


def table_property(spark: SparkSession, name: str, key: str) -> str | None:
    """A property of a catalog table, if it has it."""
    for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect():
        if row["key"] == key:
            return row["value"]
    return None


def _set_properties(spark: SparkSession, name: str, **values) -> None:
    listed = ", ".join(f"'{k}'='{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


@contextmanager
def table_lock(spark: SparkSession, name: str) -> Iterator[None]:
    """One writer of a table at a time among the threads of this driver, streaming queries included."""
    full = (name if "." in name else f"{spark.catalog.currentDatabase()}.{name}").lower()
    with _locks_guard:
        lock = _locks.setdefault(full, threading.RLock())
    with lock:
        yield


def table_state(spark: SparkSession, name: str) -> tuple[str | None, str | None] | None:
    """What tells two contents of a table apart: where it lies and its version; ``None`` for no table."""
    if not spark.catalog.tableExists(name):
        return None
    place = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Location"]
    return (place[-1] if place else None), table_property(spark, name, _VERSION)


def _settled_state(spark: SparkSession, name: str) -> tuple[str | None, str | None] | None:
    """``table_state`` once no other driver is repointing partitions, or the one that was has died."""
    until = time.monotonic() + SETTLE_SECONDS
    while True:
        state = table_state(spark, name)
        if state is None or not (state[1] or "").endswith(_OPEN) or time.monotonic() > until:
            return state
        time.sleep(0.2)


def _require(spark: SparkSession, name: str, seen) -> None:
    """The table is still as it was seen."""
    if seen != table_state(spark, name):
        raise ConcurrentMerge(name)


def replace_snapshot(
    spark: SparkSession, name: str, df: DataFrame, root: str, seen=_ANY, mark: dict | None = None
) -> None:
    """Make ``df`` the contents of the parquet table ``name``, which ``df`` may read.

    The rows go to a new folder, then the table is repointed.  A failure before
    that leaves the old snapshot in force; one after it leaves the new one in
    force and at most repeats an upsert that changes nothing.  Old folders stay
    for running readers, until their owner deletes them.  With ``seen`` (a
    ``table_state``) the table is only repointed if it is still in that state,
    else ``ConcurrentMerge`` is raised and nothing changes.  ``mark`` has table
    properties to set then.
    """
    path = f"{root.rstrip('/')}/{name}/snapshot-{uuid.uuid4().hex}"
    with no_shuffle_left(spark):
        df.write.options(**SMALL).parquet(path)
    with table_lock(spark, name):
        if seen is not _ANY:
            _require(spark, name, seen)
        if spark.catalog.tableExists(name):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        else:
            spark.catalog.createTable(name, path=path, source="parquet", schema=df.schema)
        if mark:
            _set_properties(spark, name, **mark)
        spark.catalog.refreshTable(name)


def merge_into(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys,
    update_cols=None,
    root: str | None = None,
    batch: str | None = None,
    writer: str = "",
    native: bool = False,
    buckets: int | None = None,
    evolve: bool = False,
    replaced: DataFrame | None = None,
    mark: dict | None = None,
    **options,
) -> None:
    """Upsert ``source`` into the table ``name``, created if missing.

    The table is kept under ``root``, by default the warehouse folder.  A
    ``batch`` that ``writer`` (a streaming query) merged last is not merged again;
    batches of different writers do not touch each other's marks.

    ``native`` uses the table format's own MERGE (Delta, Iceberg, ...), which
    rewrites touched files only.  Otherwise the merged snapshot is written anew,
    or, for a table created with ``buckets``, only the buckets that hold a key of
    the source (see ``merge_buckets``).

    Several writers may merge into one table.  Threads of this driver take turns.
    A writer elsewhere is noticed by the table's place and version: if they
    changed since they were read, nothing is repointed and the merge is made
    again, ``MERGE_ATTEMPTS`` times at most before ``ConcurrentMerge`` is raised.
    Between that last look and the repointing lies one catalog call; a catalog
    has no compare-and-set, so writers in several drivers that meet there need a
    table format with a log.

    ``evolve`` first gives the table the columns and the wider types of the
    source (see ``evolve_table``); columns that the source lacks keep their values.

    ``replaced``, a frame of keys, makes it a replacement in place of an upsert: rows
    of the table with one of these keys go, and all rows of the source come, of
    which several may share a key.  ``mark`` has table properties to set
    with the new contents.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if native and options.get("guard") is not None:
        raise ValueError("a guard is not passed on to the table format's own MERGE")
    if native and spark.catalog.tableExists(name):
        _native_merge(name, source, keys, update_cols)
        return
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/starloom-tables"
    with table_lock(spark, name):
        for left in reversed(range(MERGE_ATTEMPTS)):
            try:
                _merge_once(
                    spark, name, source, keys, update_cols, root, batch, writer, buckets, evolve, replaced, mark or {}, options
                )
                return
            except ConcurrentMerge:
                if not left:
                    raise


def _native_merge(name: str, source: DataFrame, keys: list[str], update_cols) -> None:
    update = update_cols if update_cols is not None else [c for c in source.columns if c not in keys]
    same = reduce(lambda a, b: a & b, [F.col(f"{name}.{k}") == F.col(f"changes.{k}") for k in keys])
    (
        source.alias("changes")
        .mergeInto(name, same)
        .whenMatched()
        .update({c: F.col(f"changes.{c}") for c in update})
        .whenNotMatched()
        .insert({c: F.col(f"changes.{c}") for c in source.columns})
        .merge()
    )


def _replace_keys(old: DataFrame, source: DataFrame, keys: list[str], replaced: DataFrame) -> DataFrame:
    gone = replaced.select(*[F.col(k).cast(old.schema[k].dataType).alias(k) for k in keys]).distinct()
    return old.join(gone, keys, "left_anti").select(*old.columns).unionByName(source)


def _merge_once(
    spark, name, source, keys, update_cols, root, batch, writer, buckets, evolve, replaced, mark, options
) -> None:
    exists = spark.catalog.tableExists(name)
    if evolve and exists:
        evolve_table(spark, name, source.schema, root)
        source, update_cols = _completed(read_table(spark, name).schema, source, keys, update_cols)
    seen = _settled_state(spark, name)
    kept = int(table_property(spark, name, _BUCKETS) or 0) if exists else buckets
    if exists and buckets is not None and buckets != kept:
        raise ValueError(f"{name} is kept in {kept or 'no'} buckets")
    if exists and batch is not None and table_property(spark, name, f"{_BATCH}.{writer}") == str(batch):
        return
    if batch is not None:
        mark = {**mark, f"{_BATCH}.{writer}": batch}
    if kept:
        merge_buckets(spark, name, source, keys, kept, root, update_cols, seen=seen, mark=mark, replaced=replaced, **options)
        return
    if not exists:
        merged = source
    elif replaced is not None:
        merged = _replace_keys(read_table(spark, name), source, keys, replaced)
    else:
        merged = merge_upsert(read_table(spark, name), source, keys, update_cols, **options)
    replace_snapshot(spark, name, merged, root, seen=seen, mark=mark)


def merge_buckets(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: list[str],
    buckets: int,
    root: str,
    update_cols=None,
    seen=_ANY,
    mark: dict | None = None,
    replaced: DataFrame | None = None,
    **options,
) -> None:
    """Upsert into a table partitioned by a hash of its keys; other partitions are not read or written.

    The touched partitions are written to a new folder, then the catalog's
    partitions are repointed one by one, so a failure in between leaves some
    buckets merged and some not: repeat the same source, which merges to the
    same rows.  A reader that starts in between sees the same mixture.  A load that
    is derived from the state of its own target should
    be written first and that copy repeated.  Rows without a whole key match
    nothing; those of a load get a partition of their own, numbered below zero.

    ``seen`` is the ``table_state`` the merge starts from: if another one is found
    before the first partition is repointed, ``ConcurrentMerge`` is raised and
    nothing changes.  ``mark`` has table properties to set with the new version.
    ``replaced`` is that of ``merge_into``; its buckets are touched as well.
    """
    exists = spark.catalog.tableExists(name)
    table = spark.read.table(name) if exists else source.withColumn(BUCKET, F.lit(0))
    schema = table.schema
    source = source.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in table.columns if c != BUCKET])
    whole, number = _bucket_of(keys, buckets)
    known: set[int] = set()
    keyed = source.where(whole)
    if exists:
        hashed = table_property(spark, name, _KEYS)
        if hashed is not None and json.loads(hashed) != keys:
            raise ValueError(f"{name} is kept in buckets by {hashed}")
        spark.catalog.refreshTable(name)
        known = {int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
        rows = keyed.select(*keys)
        if replaced is not None:
            rows = rows.unionByName(replaced.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in keys]).where(whole))
        touched = [r[0] for r in rows.select(number).distinct().collect()]  # at most ``buckets`` numbers
        old = spark.read.table(name).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        if replaced is not None:
            keyed = _replace_keys(old, keyed, keys, replaced)
        else:
            keyed = merge_upsert(old, keyed, keys, update_cols, **options)
    keyless = source.where(~whole).withColumn(BUCKET, F.lit(min(known | {0}) - 1))
    rows = keyed.withColumn(BUCKET, number).unionByName(keyless)
    path = f"{root.rstrip('/')}/{name}/buckets-{uuid.uuid4().hex}"
    with no_shuffle_left(spark):
        rows.hint("rebalance", BUCKET).write.options(**SMALL).partitionBy(BUCKET).parquet(path)
    written = _written_buckets(spark, path)
    emptied = known.intersection(touched if exists else []).difference(written)  # all their rows were replaced by none
    with table_lock(spark, name):
        if seen is not _ANY:
            _require(spark, name, seen)
        if not exists:
            _create_buckets(spark, name, rows.schema, keys, buckets, root)
        version = uuid.uuid4().hex
        _set_properties(spark, name, **{_VERSION: version + _OPEN})
        _place_buckets(spark, name, path, written, known)
        for k in emptied:
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({BUCKET}={k})")
        _set_properties(spark, name, **{_VERSION: version, **(mark or {})})
        spark.catalog.refreshTable(name)


def _written_buckets(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the buckets a job wrote below ``path``: the names of its folders."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}="))


def _bucket_of(keys: list[str], buckets: int) -> tuple[Column, Column]:
    """Whether a row has a whole key, and the number of its bucket then."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return whole, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _create_buckets(spark: SparkSession, name: str, schema: T.StructType, keys: list[str], buckets: int, root: str) -> None:
    empty = spark.createDataFrame([], schema)
    made = empty.writeTo(name).using("parquet").partitionedBy(F.col(BUCKET))
    made = made.tableProperty(_BUCKETS, str(buckets)).tableProperty(_KEYS, json.dumps(keys))
    made.option("path", f"{root.rstrip('/')}/{name}/base-{uuid.uuid4().hex}").create()


def _place_buckets(spark: SparkSession, name: str, path: str, written: list[int], known: set[int]) -> None:
    """Let the partitions ``written`` be the ones below ``path``."""
    place = lambda k: f"PARTITION ({BUCKET}={k})"
    fresh = [f"{place(k)} LOCATION '{path}/{BUCKET}={k}'" for k in written if k not in known]
    if fresh:
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(fresh)}")
    for k in known.intersection(written):
        spark.sql(f"ALTER TABLE {name} {place(k)} SET LOCATION '{path}/{BUCKET}={k}'")


_INTEGERS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}  # and their decimal digits


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both without loss; ``ValueError`` if there is none.

    Integers widen, ``float`` to ``double``, decimals to what both need, integers
    to decimals, ``date`` to a timestamp, and anything but binary to ``string``.
    """
    if a == b:
        return a
    names = [t.simpleString() for t in (a, b)]
    if all(n in _INTEGERS for n in names):
        return max((a, b), key=lambda t: _INTEGERS[t.simpleString()])
    if set(names) == {"float", "double"}:
        return T.DoubleType()
    decimals = [
        t if isinstance(t, T.DecimalType) else T.DecimalType(_INTEGERS[n], 0) for t, n in zip((a, b), names) if isinstance(t, T.DecimalType) or n in _INTEGERS
    ]
    if len(decimals) == 2:
        scale = max(t.scale for t in decimals)
        digits = max(t.precision - t.scale for t in decimals)
        if digits + scale <= 38:
            return T.DecimalType(digits + scale, scale)
    if "date" in names and any(n.startswith("timestamp") for n in names):
        return a if names[1] == "date" else b
    if "string" in names and not any(n == "binary" or "<" in n for n in names):
        return T.StringType()
    raise ValueError(f"no type holds both {names[0]} and {names[1]}")


def evolve_table(spark: SparkSession, name: str, schema: T.StructType, root: str) -> list[str]:
    """Give a table the columns and types of ``schema`` as well; the names of columns added or widened.

    New columns are added at the end and read NULL in old rows; nothing is
    written for them.  A type that cannot hold the new values becomes the
    ``wider_type`` of both; the table is then written anew once, as its files have
    the old type.  The table keeps its buckets and the marks of its writers.  It is
    missing for a moment while it is declared anew, for writers of this
    driver the lock hides that.
    """
    with table_lock(spark, name):
        table = read_table(spark, name)
        now = {f.name.lower(): f for f in table.schema.fields}
        added = [f for f in schema.fields if f.name.lower() not in now]
        wider = {}
        for f in schema.fields:
            old = now.get(f.name.lower())
            if old is not None and wider_type(old.dataType, f.dataType) != old.dataType:
                wider[old.name] = wider_type(old.dataType, f.dataType)
        if wider:
            columns = [F.col(c).cast(wider[c]).alias(c) if c in wider else F.col(c) for c in table.columns]
            columns += [F.lit(None).cast(f.dataType).alias(f.name) for f in added]
            _declare_anew(spark, name, columns, root)
        elif added:
            listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({listed})")
            spark.catalog.refreshTable(name)
        return [f.name for f in added] + list(wider)


def _declare_anew(spark: SparkSession, name: str, columns: list, root: str) -> None:
    """Write the rows of a table with other columns and declare it again over them."""
    marks = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect() if r["key"].startswith("starloom.")}
    buckets, keys = int(marks.pop(_BUCKETS, 0)), json.loads(marks.pop(_KEYS, "null"))
    if buckets and keys is None:
        raise ValueError(f"{name} does not say by which keys it is kept in buckets")
    marks[_VERSION] = uuid.uuid4().hex
    table = spark.read.table(name)
    path = f"{root.rstrip('/')}/{name}/evolved-{uuid.uuid4().hex}"
    if buckets:
        # A key of another type has another hash.
        whole, number = _bucket_of(keys, buckets)
        rows = table.select(*columns, BUCKET).withColumn(BUCKET, F.when(whole, number).otherwise(F.col(BUCKET)))
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
        written = _written_buckets(spark, path)
        spark.sql(f"DROP TABLE {name}")  # its folders are outside the catalog and stay
        _create_buckets(spark, name, rows.schema, keys, buckets, root)
        _place_buckets(spark, name, path, written, set())
    else:
        rows = table.select(*columns)
        rows.write.parquet(path)
        spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, path=path, source="parquet", schema=rows.schema)
    _set_properties(spark, name, **marks)
    spark.catalog.refreshTable(name)


def _completed(schema: T.StructType, source: DataFrame, keys: list[str], update_cols) -> tuple[DataFrame, list[str]]:
    """``source`` with all columns of a table, and the columns to update: those it had."""
    has = {c.lower(): c for c in source.columns}
    columns = [
        F.col(has[f.name.lower()]).alias(f.name) if f.name.lower() in has else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    update = [c for c in source.columns if c not in keys] if update_cols is None else list(update_cols)
    taken = {c.lower() for c in update}
    return source.select(*columns), [f.name for f in schema.fields if f.name.lower() in taken]


def save(df: DataFrame, name: str, mode: str, keys=None, **options) -> None:
    """``overwrite``, ``append`` or ``merge`` into a catalog table."""
    if mode == "overwrite":
        overwrite(df, name)
    elif mode == "append":
        append(df, name)
    elif mode == "merge":
        merge_into(df.sparkSession, name, df, keys, **options)
    else:
        raise UnsupportedSaveMode(mode)


def warehouse_options(kind: str, table: str, **settings) -> tuple[str, dict]:
    """(format, options) of an external warehouse sink.

    ``table`` is a target table such as ``dimension_city``; its schema is
    ``Dimension`` or ``Fact``.  Fixed values: the option names and formats.
    """
    schema = "Dimension" if table.startswith("dimension_") else "Fact"
    login = f"{settings.get('url')};user={settings.get('user')};password={settings.get('password')}"
    if kind == "sqlserver":
        return "jdbc", {
            "url": login,
            "dbtable": f"{schema}.{table}",
            "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        }
    if kind == "synapse":
        return "com.databricks.spark.sqldw", {
            "useAzureMSI": "true",
            "url": login,
            "dbtable": f"{schema}.{table}",
            "tempDir": settings["temp_dir"],
        }
    if kind == "snowflake":
        return "snowflake", {
            "sfUrl": settings["url"],
            "sfUser": settings["user"],
            "sfPassword": settings["password"],
            "sfDatabase": settings["database"],
            "sfSchema": schema.upper(),
            "sfWarehouse": settings["warehouse"],
            "dbtable": table.upper(),
        }
    raise ValueError(kind)


def write_external(df: DataFrame, fmt: str, options: dict, mode: str = "overwrite") -> None:
    """Overwrite or append an external table; these sinks have no merge."""
    if mode not in ("overwrite", "append"):
        raise UnsupportedSaveMode(mode)
    df.write.format(fmt).options(**options).mode(mode).save()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options) -> None:
    write_external(df, "jdbc", {"url": url, "dbtable": table, **options}, mode)


def export_sample(df: DataFrame, path: str, order_by, rows: int = 100) -> None:
    """The first ``rows`` rows by ``order_by`` as one tab-separated file with a header.

    Sorting before the limit lets every task keep its own first rows only; the
    single output file then holds ``rows`` rows at most.
    """
    first = df.orderBy(*([order_by] if isinstance(order_by, str) else order_by)).limit(rows)
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    first.coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True, **keep)


def export_samples(tables: dict[str, DataFrame], root: str, rows: int = 100) -> None:
    """A sample of each source table, in its own folder; ties are settled by the first column."""
    for name, df in tables.items():
        order = SAMPLE_ORDER.get(name, [])
        export_sample(df, table_path(root, name), [*order, *[c for c in df.columns[:1] if c not in order]], rows)
