"""Table, file and JDBC scans."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.constants import GEOGRAPHY_COLUMNS

BUCKET = "starloom_bucket"  # partition column of tables that are merged by bucket


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or files by path.

    The table may have been repointed by another session, a running stream
    say, so what this session remembers of it is dropped first.  The partition
    column of a table kept in buckets is left out.
    """
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    spark.catalog.refreshTable(name_or_path)
    return spark.read.table(name_or_path).drop(BUCKET)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    """Tab-separated text with a header, typed by a declared schema."""
    return spark.read.csv(path, schema=schema, sep="\t", header=True, **{"multiLine": True, **options})


def load_schema(path: str) -> T.StructType:
    """A declared schema from its JSON file."""
    return T.StructType.fromJson(json.loads(Path(path).read_text()))


def load_schemas(folder: str) -> dict[str, T.StructType]:
    """The declared schemas of all tables: ``Schema_Table.json`` files anywhere below a folder."""
    return {path.stem: load_schema(str(path)) for path in sorted(Path(folder).rglob("*.json"))}


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The table ``name``, created empty from ``schema`` if missing."""
    if not spark.catalog.tableExists(name):
        empty_table(spark, schema).write.format(fmt).saveAsTable(name)
    return spark.read.table(name)


def extract_columns(df: DataFrame, columns: list[str], as_text: list[str] = ()) -> DataFrame:
    """Project the declared columns; geography and the like become text."""
    return df.select(*[F.col(c).cast("string").alias(c) if c in as_text else F.col(c) for c in columns])


def extract_sql(table: str, columns: list[str], archive: bool = False, text_type: str = "varchar(max)") -> str:
    """Projection of one source table as SQL text to be run at the source.

    Spark pushes the load window into it, see ``read_jdbc``.
    """
    schema, name = table.split("_", 1)
    as_text = GEOGRAPHY_COLUMNS.get(table, [])
    listed = [f"CAST({c} AS {text_type}) AS {c}" if c in as_text else c for c in columns]
    return f"SELECT {', '.join(listed)} FROM {schema}.{name}{'_Archive' if archive else ''}"


def jdbc_options(url: str, query: str, driver: str | None = None, split: dict | None = None, **options) -> dict:
    """Reader options of a JDBC query.

    Without ``split`` the query is read by one task.  ``split`` names a numeric
    or time column with its bounds and the number of concurrent reads
    (``column``, ``lower``, ``upper``, ``partitions``); rows outside the bounds
    still arrive, in the first and last partition.
    """
    out = {"url": url, **({"driver": driver} if driver else {}), **options}
    if split is None:
        return {**out, "query": query}
    return {
        **out,
        "dbtable": f"({query}) src",
        "partitionColumn": split["column"],
        "lowerBound": str(split["lower"]),
        "upperBound": str(split["upper"]),
        "numPartitions": str(split["partitions"]),
    }


def read_jdbc(
    spark: SparkSession, url: str, query: str, driver: str | None = None, split: dict | None = None, **options
) -> DataFrame:
    """Run ``query`` at the source; filters put on the result are pushed into it."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, driver, split, **options)).load()
