"""Intermediate tables in the cluster's shared folder.

A staged table fixes the contents and the partitioning of an intermediate
result: later jobs read files that outlive any executor, only the columns they
need, with sizes Catalyst knows.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import not_null

_local_folder: str | None = None
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SMALL = {"compression": "zstd"}  # options for tables with many rows that are written once and read a few times
_lock = threading.Lock()
_open: dict[int, list] = {}  # by session: writes under way, and the setting before them
_recorders = threading.local()  # lists that take the paths of what is staged now, by thread


def staging_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="starloom-")
    return _local_folder


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_folder(spark)}/starloom/{label}-{uuid.uuid4().hex}"


@contextmanager
def recorded():
    """The paths of the tables staged in here, in a list."""
    before, made = getattr(_recorders, "open", []), []
    _recorders.open = [*before, made]
    try:
        yield made
    finally:
        _recorders.open = before


@contextmanager
def unrecorded():
    """What is staged in here outlives what is built from it, whoever records."""
    before, _recorders.open = getattr(_recorders, "open", []), []
    try:
        yield
    finally:
        _recorders.open = before


def release(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete staged tables that nothing reads any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def with_scratch(df: DataFrame, paths: list[str]) -> DataFrame:
    """``df`` with the staged tables that only it reads, for ``last_use``."""
    df._starloom_scratch = list(paths)
    return df


def last_use(df: DataFrame) -> None:
    """``df`` has been written and is not read again, so the tables staged for it alone go."""
    release(df.sparkSession, df.__dict__.pop("_starloom_scratch", []))


@contextmanager
def no_shuffle_left(spark: SparkSession):
    """Shuffle files of what is run in here go when it has ended, not when the driver collects garbage.

    For writes: nobody reads their shuffles again.  Should anybody, Spark makes them anew.
    """
    session = spark._jsparkSession.hashCode()
    with _lock:
        _open.setdefault(session, [0, spark.conf.get(_CLEANUP, "false")])[0] += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            _open[session][0] -= 1
            if not _open[session][0]:
                spark.conf.set(_CLEANUP, _open.pop(session)[1])


def stage(df: DataFrame, label: str, keep_not_null: bool = False, **options) -> DataFrame:
    """Write ``df`` once and return the written table.

    Files do not record that a column is never null; ``keep_not_null`` declares
    it again.  ``options`` are those of the writer.
    """
    return stage_parts([df], label, keep_not_null, **options)


def stage_parts(parts: Iterable[DataFrame], label: str, keep_not_null: bool = False, **options) -> DataFrame:
    """Write frames of one schema one after the other into one table and return it.

    Each part's shuffles are gone before the next one's are made, so a table written in
    parts needs the disk of one part's shuffles.
    """
    schema, path = None, None
    for df in parts:
        spark = df.sparkSession
        if path is None:
            schema, path = df.schema, staging_path(spark, label)
            for made in getattr(_recorders, "open", []):
                made.append(path)
        with no_shuffle_left(spark):
            df.write.mode("append").options(**options).parquet(path)
    staged = spark.read.schema(schema).parquet(path)
    return as_written(restore_not_null(staged, schema) if keep_not_null else staged)


def as_written(df: DataFrame) -> DataFrame:
    """``df``, which only reads a staged table, marked as such for ``written``."""
    df._starloom_written = True
    return df


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` itself if ``stage`` returned it, else staged."""
    return df if getattr(df, "_starloom_written", False) else stage(df, label, **SMALL)


def stage_last(df: DataFrame, label: str) -> DataFrame:
    """``written``, where ``df`` itself is not read again."""
    staged = written(df, label)
    if staged is not df:
        last_use(df)
    return staged


def restore_not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(
        *[F.col(f.name) if f.nullable else not_null(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields]
    )
