"""Sharding (operator 7): contiguous shards of nearly equal bytes from global prefix sums.

The rows (id, size, checksum; no texts) are dealt into id ranges and sorted there. Each range's total gives, summed over
the ranges before it, where its own running sum begins; a row goes to the shard in which the middle of its bytes falls.

Cases: a null text has no bytes (size 8) and checksum 0; equal ids keep the order of their sizes and checksums; a null
id sorts first; an empty table gives an empty result; repeated rows are all kept; other columns are not looked at.
Groups of equal texts are not held together: the law is `bytes`, and a group of a third of all rows could not be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, parts

EXTRA = 8


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    raw = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), (F.octet_length(raw).cast("long") + EXTRA).alias("size"), F.crc32(raw).alias("text_crc32"))
    rows = scratch.table(rows.withColumn("tie", F.monotonically_increasing_id()), "rows")
    order = ["doc_id", "size", "text_crc32", "tie"]
    ranges = rows.repartitionByRange(parts(spark), *order).sortWithinPartitions(*order)
    ranges = scratch.table(ranges.withColumn("part", F.spark_partition_id()), "ranges")
    totals = ranges.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # one row per range: as many as there are partitions
    offsets = totals.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"), F.sum("bytes").over(everything).alias("total"))
    offsets = scratch.table(offsets, "offsets")
    within = Window.partitionBy("part").orderBy("doc_id", "size", "text_crc32", "tie")
    placed = ranges.select("*", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.row_number().over(within).alias("rank"))
    placed = placed.join(F.broadcast(offsets), "part").select("doc_id", "size", "text_crc32", (F.col("n_before") + F.col("rank") - 1).alias("at"), (F.col("bytes_before") + F.col("upto")).alias("end"), "total")
    middle = (2 * F.col("end") - F.col("size")).cast("decimal(38,0)") * shards
    placed = placed.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle / (2 * F.col("total")).cast("decimal(20,0)")).cast("int")))
    placed = scratch.table(placed.drop("end", "total"), "placed")
    first = placed.groupBy("shard").agg(F.min("at").alias("first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("at") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
