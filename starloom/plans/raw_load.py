"""Incremental copy of the operational tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.constants import TEMPORAL_TABLES
from starloom.operators.incremental import high_water_mark, stamp, temporal_union, window_filter
from starloom.operators.merge import merge_all, merge_keep_stamp
from starloom.sources.sinks import merge_into
from starloom.sources.staging import stage
from starloom.sources.tables import empty_table, ensure_table, extract_sql, load_schemas, read_jdbc


def extract_regular(source: DataFrame, load_time, last_load=None) -> DataFrame:
    """Rows edited after the last load and up to this one, stamped."""
    return stamp(window_filter(source, "LastEditedWhen", last_load, load_time), load_time)


def extract_temporal(current: DataFrame, archive: DataFrame, load_time, last_load=None) -> DataFrame:
    """Versions started or ended after the last load and up to this one, stamped."""
    return stamp(temporal_union(current, archive, last_load, load_time), load_time)


def load_regular(target: DataFrame, source: DataFrame, key: str, load_time) -> DataFrame:
    """The target of a mutable table after one load."""
    return merge_all(target, extract_regular(source, load_time, high_water_mark(target)), [key])


def load_temporal(target: DataFrame, current: DataFrame, archive: DataFrame, key: str, load_time) -> DataFrame:
    """The target of a versioned table after one load."""
    rows = extract_temporal(current, archive, load_time, high_water_mark(target))
    return merge_keep_stamp(target, rows, [key, "ValidFrom"])


def load_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    load_time,
    read: Callable[[str], DataFrame],
    target_schema: str,
    key: str | None = None,
    **options,
) -> None:
    """Copy the changes of one source table into ``target_schema.name``.

    ``read`` runs a projection at the source, for instance
    ``lambda sql: read_jdbc(spark, url, sql)``; the load window becomes a
    filter Spark pushes into it.  ``schema`` is the declared target schema with
    ``LoadDatetime`` last; the key is its first column unless named.
    """
    target_name = f"{target_schema}.{name}"
    columns = [f.name for f in schema.fields if f.name != "LoadDatetime"]
    key = key or columns[0]
    if options.get("buckets") and not spark.catalog.tableExists(target_name):
        merge_keys = [key, "ValidFrom"] if name in TEMPORAL_TABLES else [key]
        merge_into(spark, target_name, empty_table(spark, schema), merge_keys, **options)
    target = ensure_table(spark, target_name, schema)
    last = high_water_mark(target)
    current = read(extract_sql(name, columns))
    if name in TEMPORAL_TABLES:
        archive = read(extract_sql(name, columns, archive=True))
        # Written once: the source is read a single time however often the merge reads its rows.
        rows = stage(extract_temporal(current, archive, load_time, last), f"load-{name}")
        merge_into(spark, target_name, rows, [key, "ValidFrom"], columns, **options)
    else:
        rows = stage(extract_regular(current, load_time, last), f"load-{name}")
        merge_into(spark, target_name, rows, [key], rows.columns, **options)


def load_tables(
    spark: SparkSession,
    url: str,
    schemas: dict[str, T.StructType] | str,
    load_time,
    target_schema: str,
    splits: dict[str, dict] | None = None,
    **options,
) -> None:
    """Copy the changes of all tables in ``schemas`` over JDBC.

    ``schemas`` maps table names to declared schemas or names the folder of
    their JSON files.  ``splits[name]`` has the column, bounds and number of the
    concurrent reads of a table (see ``jdbc_options``); others are read by one task.
    """
    for name, schema in (load_schemas(schemas) if isinstance(schemas, str) else schemas).items():
        read = partial(_read_source, spark, url, (splits or {}).get(name))
        load_table(spark, name, schema, load_time, read, target_schema, **options)


def _read_source(spark: SparkSession, url: str, split: dict | None, sql: str) -> DataFrame:
    return read_jdbc(spark, url, sql, split=split)
