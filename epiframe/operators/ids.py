"""Row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from epiframe.session import cut_counted, cut_lineage

BUCKET_WIDTH = 1 << 20
#: Splits whose offsets are sent to every task, about 50 MB; more of them are joined in shuffled form.
SPLITS = 1 << 18


def dense_id(df: DataFrame, key: str, out: str, width: int = BUCKET_WIDTH) -> DataFrame:
    """Add ``out`` = 1, 2, 3, ... in the order of the unique integer column ``key``.

    Rows are numbered inside fixed key ranges of ``width``; since the key is unique, a range
    never holds more than ``width`` rows whatever the data looks like. Range offsets come
    from a two-level prefix sum, so the only single-task step sees one row per
    ``width * width`` keys. The ranges are plain arithmetic on the key: a recomputed task
    gives every row the number it had before.
    """
    cell, block = f"__{out}_cell", f"__{out}_block"
    ranged = df.withColumn(cell, F.floor(F.col(key) / width))

    sizes = ranged.groupBy(cell).agg(F.count("*").alias("n"))
    sizes = sizes.withColumn(block, F.floor(F.col(cell) / width))
    blocks = sizes.groupBy(block).agg(F.sum("n").alias("n"))
    before = (Window.unboundedPreceding, -1)
    block_start = blocks.select(
        block, F.coalesce(F.sum("n").over(Window.orderBy(block).rowsBetween(*before)), F.lit(0)).alias("b")
    )
    in_block = F.sum("n").over(Window.partitionBy(block).orderBy(cell).rowsBetween(*before))
    starts = (
        sizes.withColumn("c", F.coalesce(in_block, F.lit(0)))
        .join(block_start, block)
        .select(cell, (F.col("b") + F.col("c")).alias("__start"))
    )
    numbered = ranged.withColumn(
        "__rank", F.row_number().over(Window.partitionBy(cell).orderBy(key))
    )
    return (
        numbered.join(starts, cell)
        .withColumn(out, (F.col("__start") + F.col("__rank")).cast("long"))
        .select(out, *df.columns)
    )


def arrival_id(df: DataFrame, out: str = "row_id") -> DataFrame:
    """Add ``out`` = 1, 2, 3, ... in file order to a frame that is a plain file scan.

    The files are scanned once: the rows are written with their split and their running number, and
    read back. The rows of one file split sit next to each other in one task, so a row's place in its
    split is its running number minus the split's smallest one. Only one row per split is
    aggregated and prefix-summed, from the written columns that tell splits apart; the records
    themselves are never sorted or shuffled while there are up to ``SPLITS`` splits.
    """
    split = ["__file", "__block"]
    tagged = cut_lineage(df.select(
        F.monotonically_increasing_id().alias("__pos"),
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        *df.columns,
    ))
    sizes = tagged.groupBy(*split).agg(F.min("__pos").alias("__first"), F.count("*").alias("__n"))
    # The total before a split: within its file, plus that of all earlier files, so that no window sees more than one row a file.
    before = (Window.unboundedPreceding, -1)
    files = sizes.groupBy("__file").agg(F.sum("__n").alias("__rows"))
    files = files.select("__file", F.coalesce(F.sum("__rows").over(Window.orderBy("__file").rowsBetween(*before)), F.lit(0)).alias("__files"))
    inside = F.coalesce(F.sum("__n").over(Window.partitionBy("__file").orderBy("__block").rowsBetween(*before)), F.lit(0))
    starts = sizes.withColumn("__inside", inside).join(files, "__file").select(
        *split, (F.col("__files") + F.col("__inside") - F.col("__first")).alias("__shift"))
    starts, splits = cut_counted(starts)
    starts = F.broadcast(starts) if splits <= SPLITS else starts
    return tagged.join(starts, split).select((F.col("__pos") + F.col("__shift") + 1).alias(out), *df.columns)
