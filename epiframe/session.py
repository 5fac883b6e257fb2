"""Session settings the library expects, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM never compiles methods beyond this size; wide projections of many parsed
    # columns run about twice as fast when Spark splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: str = "8", app: str = "epiframe", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it.

    Only a local session without the setting gets a folder of its own; a cluster's executors
    would each write to their own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder all executors share (master {master})")
    fallback = tempfile.mkdtemp(prefix="epiframe-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


#: Folders of the frames that were cut inside the innermost ``brief`` block.
_cut_here: ContextVar[list[str] | None] = ContextVar("cut_here", default=None)


def release(spark: SparkSession) -> None:
    """Shuffle files go once the plans that wrote them are garbage on the driver; ask for that now."""
    spark.sparkContext._jvm.System.gc()


@contextmanager
def brief(spark: SparkSession) -> Iterator[None]:
    """Frames cut inside the block last as long as it: at its end their files go, and those of finished shuffles."""
    folders: list[str] = []
    outer = _cut_here.set(folders)
    try:
        yield
    finally:
        _cut_here.reset(outer)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        release(spark)


def observed(seen: Observation) -> dict:
    """Metrics of a finished write; none where the engine saw beforehand that there are no rows."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception.getClass().getName()):
            raise
        return {}


def cut_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` as a table written to the shared folder and read back, and its row count.

    For frames that many later jobs read: a lost executor costs a re-read, not a recompute,
    and each of those jobs is planned from a plain scan. Inside ``brief`` the table goes with the block.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    seen, here = Observation(), _cut_here.get()
    if here is not None:
        here.append(path)
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path), observed(seen).get("n", 0)


def cut_lineage(df: DataFrame) -> DataFrame:
    return cut_counted(df)[0]
