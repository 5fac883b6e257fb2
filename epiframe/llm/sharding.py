"""Contiguous shards of near equal byte size, cut by global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from epiframe.llm.common import Scratch, partitions


def balanced_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shards 0 to ``shards`` - 1 of documents in id order, with sizes near equal (law ``bytes``).

    A document weighs the UTF-8 bytes of its text plus one. Documents are ordered by doc_id (nulls
    first), then size, checksum and place in the input; the one whose middle byte lies in the s-th
    of ``shards`` equal stretches of the total goes to shard s, so that a shard differs from the
    target by less than the largest document. Only totals of range partitions meet in one task.

    A null text has size 1 and checksum 0; repeated rows and ids are documents of their own; an
    empty table gives no rows; other columns of the input are not read.
    Result: doc_id, size, text_crc32, law, shard, slot (from 0 in each shard, gapless).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    light = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("place"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32"), F.col("place")]
    light = scratch.cut(light, "sizes")
    ranged = light.repartitionByRange(partitions(spark), *order).withColumn("part", F.spark_partition_id())
    ranged = scratch.cut(ranged, "ranged")

    totals = ranged.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(  # one row for each range partition
        "part",
        F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_bytes").over(W.partitionBy()).alias("total"),
    )
    inside = W.partitionBy("part").orderBy(*order)
    placed = ranged.join(F.broadcast(totals), "part").select(
        "doc_id", "size", "text_crc32",
        (F.col("bytes_before") + F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")).alias("start"),
        (F.col("rows_before") + F.row_number().over(inside) - 1).alias("row"),
        "total",
    )
    shard = F.expr(f"CAST(least((start + size div 2) * {shards} div total, {shards - 1}) AS INT)")
    placed = scratch.cut(placed.withColumn("shard", shard), "placed")
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))  # at most ``shards`` rows
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first")).alias("slot")
    )
