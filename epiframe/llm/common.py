"""Pieces shared by the corpus operators: scratch tables, word splitting, Arrow text blocks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from epiframe.session import shared_dir

#: White space that parts words: blank and the five control characters from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"


class Scratch:
    """Tables in the folder that all executors share, for cutting lineage inside one operator.

    A lost executor then costs a re-read of a table, not a recompute. ``drop`` removes a table
    that no later step reads, and lets Spark delete the shuffle files of finished steps.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
        self.count = 0

    def path(self, name: str = "table") -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def cut(self, df: DataFrame, name: str = "table") -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        self.release()
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.release()

    def clear(self, *but: DataFrame) -> None:
        """Remove all tables of this operator except some."""
        stay = {table.scratch_path.rstrip("/").rpartition("/")[2] for table in but}
        home = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = home.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for found in files.listStatus(home) if files.exists(home) else []:
            if found.getPath().getName() not in stay:
                files.delete(found.getPath(), True)
        self.release()

    def release(self) -> None:
        """Shuffle files go once their plans are garbage on the driver; ask for that now."""
        self.spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with as many underscores as it takes to be none of ``columns`` (case does not tell them apart)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """The words of a text, an empty array for a null one."""
    blanks = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.array_remove(F.split(blanks, " "), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also when body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 22) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``limit`` bytes of text: first row, row after the last, bytes, starts.

    ``starts`` has one entry more than rows. A longer text makes a block of its own; null is empty.
    """
    texts = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    rows = len(texts)
    if not rows:
        return
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + rows + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        end = max(first + 1, int(np.searchsorted(starts, starts[first] + limit, "right")) - 1)
        yield first, end, raw[starts[first] : starts[end]], starts[first : end + 1] - starts[first]
        first = end


#: Lower case of A to Z only, byte by byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_BYTES = LOWER.tobytes()

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


CODES = mix(mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE)))


class Hashes:
    """Hashes of any substrings of one byte array, from prefix sums modulo 2 ** 64."""

    powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __init__(self, raw: np.ndarray):
        n = len(raw)
        if len(self.powers[0]) <= n:
            for i, base in enumerate((BASE, INVERSE)):
                steps = np.full(n + 1, base, np.uint64)
                steps[0] = 1
                self.powers[i] = np.cumprod(steps)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(CODES[raw] * self.powers[0][:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.powers[1][start])

    def grams(self, k: int) -> np.ndarray:
        return mix((self.sums[k:] - self.sums[:-k]) * self.powers[1][: len(self.sums) - k])


def salted(hashes: np.ndarray, *numbers: np.ndarray) -> np.ndarray:
    for i, n in enumerate(numbers):
        hashes = mix(hashes + (n.astype(np.uint64) + np.uint64(1)) * CODES[i])
    return hashes


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, label: the least node of each connected component, for every node of ``edges`` (a, b).

    Each round takes the least label among neighbours and then that label's own label, so a long
    chain halves; every round's labels are written, and one count a round reaches the driver.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = scratch.cut(both, "edges")
    labels = scratch.cut(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        least = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "label", F.least("label", "near").alias("least"))
        jump = labels.select(F.col("node").alias("least"), F.col("label").alias("next"))
        moved = least.join(jump, "least").select("node", F.col("label").alias("old"), F.least("least", "next").alias("label"))
        moved = scratch.cut(moved, "labels")
        labels = moved.select("node", "label")
        if not moved.filter("old <> label").limit(1).count():
            return labels
