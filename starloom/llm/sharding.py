"""Contiguous shards of nearly equal bytes from global prefix sums (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.sources.staging import stage

_ROW_BITS = 33  # monotonically_increasing_id(): partition number above, row number below


def shard_by_bytes(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut the documents, in the order of their id, into ``shards`` runs of nearly equal bytes.

    Narrow rows (id, size, checksum) are range-partitioned, sorted and written
    once.  The totals of the partitions, one row each, give every partition the
    bytes and rows before it; a running sum inside the partition does the rest.
    A document belongs to the shard that holds the middle of its bytes, so a
    shard's total differs from the target by less than its two outer documents.

    Sizes are UTF-8 bytes plus 1; a missing text has size 1 and the checksum of
    the empty text.  Missing ids come first.  Repeated ids are ordered by
    checksum, size and input position, so a repeated row is placed as often as
    it occurs and one frequent id is spread over partitions.  No input, no rows.
    Other columns of ``docs`` are ignored.

    Returns ``doc_id, size, text_crc32, shard, slot``; slots count from 0 in each shard.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_in"),
    )
    order = ["doc_id", "text_crc32", "size", "_in"]
    placed = narrow.repartitionByRange(*order).sortWithinPartitions(*order).drop("_in")
    placed = stage(placed.withColumn("_pos", F.monotonically_increasing_id()), "shards")
    placed = placed.withColumn("_part", F.shiftright("_pos", _ROW_BITS))

    totals = placed.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_first_byte"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first_row"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_all"),
    )
    running = Window.partitionBy("_part").orderBy("_pos")
    inside = placed.withColumn("_upto", F.sum("size").over(running)).withColumn("_row", F.row_number().over(running) - 1)
    # One row per partition of the sorted table bounds this broadcast.
    placed = inside.join(F.broadcast(starts), "_part").select(
        "doc_id",
        "size",
        "text_crc32",
        (F.col("_first_row") + F.col("_row")).alias("_rank"),
        F.least(
            F.expr(f"(2 * (_first_byte + _upto) - size) * {shards} div (2 * _all)"), F.lit(shards - 1)
        ).cast("int").alias("shard"),
    )
    first = placed.groupBy("shard").agg(F.min("_rank").alias("_start"))  # at most ``shards`` rows
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_rank") - F.col("_start")).alias("slot")
    )
