"""Change-stream sources."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def kafka_options(servers: str, table: str, prefix: str = "WWI") -> dict:
    """One topic per table, ``<prefix>.<schema>.<table>``, read from the beginning."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": f"{prefix}.{table.replace('_', '.')}" if table else prefix,
        "startingOffsets": "earliest",
    }


def event_hubs_options(connection: str, consumer_group: str) -> dict:
    """Option names and the starting position of the hub connector."""
    start = {"offset": -1, "seqNo": -1, "enqueuedTime": None, "isInclusive": True}
    return {
        "eventhubs.connectionString": connection,
        "eventhubs.consumerGroup": consumer_group,
        "eventhubs.startingPosition": json.dumps(start),
    }


def event_hub_name(table: str) -> str:
    return f"cdc.{table.replace('_', '.')}" if table else "cdc"


def read_changes(spark: SparkSession, fmt: str, options: dict, value_col: str = "value", path=None) -> DataFrame:
    """A change stream with its message in the column ``value``."""
    reader = spark.readStream.format(fmt).options(**options)
    stream = reader.load(path) if path else reader.load()
    return stream.withColumnRenamed(value_col, "value")
