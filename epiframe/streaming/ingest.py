"""Arriving notifications as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from epiframe.contracts import CONFIRMED
from epiframe.operators.ingest import as_cases, with_reason
from epiframe.plans.changes import insert_batch
from epiframe.sources.store import Store


def stream_ingest(
    arriving: DataFrame, patients: DataFrame, units: DataFrame, row_key: str, out: str, checkpoint: str
) -> StreamingQuery:
    """Validate each micro-batch and write ``out/accepted`` and ``out/rejected``.

    The id of an accepted case is its ``row_key``. Every micro-batch has its own folder, which
    a repeated attempt replaces, so a failure halfway leaves no record twice.
    """

    def step(batch: DataFrame, number: int) -> None:
        path = f"{out}/checked/batch={number}"  # checked once, then parted by reading it
        with_reason(batch, patients, units).write.mode("overwrite").parquet(path)
        checked = batch.sparkSession.read.parquet(path)
        good = as_cases(checked.filter(F.col("motivo").isNull()), F.col(row_key))
        good.write.mode("overwrite").parquet(f"{out}/accepted/batch={number}")
        bad = checked.filter(F.col("motivo").isNotNull())
        bad.write.mode("overwrite").parquet(f"{out}/rejected/batch={number}")

    return (
        arriving.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_insert(arriving: DataFrame, store: Store, row_key: str, name: str, checkpoint: str) -> StreamingQuery:
    """Validate each micro-batch into the published case table, see ``insert_batch``.

    ``name`` and the batch's number are its entry in the ledger, so a micro-batch that Spark repeats after a
    failure neither doubles nor renumbers its records. Another stream needs another name.
    """

    def step(batch: DataFrame, number: int) -> None:
        insert_batch(store, batch, f"{name}-{number}", row_key)

    return (
        arriving.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def weekly_rows(stream: DataFrame, time: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Keys and Monday of each record, by the wall clock of the session's time zone."""
    return stream.select(*by, F.date_trunc("week", F.col(time).cast("timestamp")).cast("date").alias("semana"))


def weekly_confirmed(stream: DataFrame, time: str) -> DataFrame:
    """The same over confirmed cases only."""
    return weekly_rows(stream.filter(F.col("classificacao_final") == CONFIRMED), time)


def write_weekly(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch's counts by week as a folder of their own under ``out``.

    There is no watermark: a record counts in its week however late it arrives, and no state is
    kept between batches. ``weekly_totals`` adds the folders up.
    """
    keys = rows.columns

    def step(batch: DataFrame, number: int) -> None:
        counts = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("casos"))
        counts.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        rows.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def weekly_totals(written: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Count per week over all folders of ``write_weekly``."""
    return written.groupBy(*by, "semana").agg(F.sum("casos").alias("casos"))
