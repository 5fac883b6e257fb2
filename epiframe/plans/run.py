"""From raw files to published silver and gold tables."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from epiframe.contracts import STUDY_END, STUDY_START
from epiframe.plans.gold import gold_tables
from epiframe.plans.silver import Silver
from epiframe.sources.bronze import read_case_file, read_gazetteer
from epiframe.sources.store import Store
from epiframe.sources.tables import stage_silver, write_counted

log = logging.getLogger(__name__)


def run(
    spark: SparkSession, cases: str | list[str], gazetteer: str, bronze_root: str, root: str,
    study: tuple[str, str] = (STUDY_START, STUDY_END), strict: bool = True, gazetteer_skip: int = 6,
    restarts: int = 10, invalid: str | None = None,
) -> dict[str, int]:
    """Build everything and publish silver, base and gold in one snapshot; returns the row count of each table.

    The raw text is parsed once, into a columnar copy with record numbers, of which one scan gives the codes of
    all dimensions; every later stage reads only the columns it needs from the tables written before. Readers of the store at ``root`` see the
    old tables, all of them, until the new ones are all there.
    """
    counts = {"bronze": write_counted(read_case_file(spark, cases), f"{bronze_root}/casos")}
    silver = Silver(spark.read.parquet(f"{bronze_root}/casos"), read_gazetteer(spark, gazetteer, gazetteer_skip)).settle()
    tx = Store(spark, root).begin()
    counts |= stage_silver(tx, silver, strict, invalid)
    # The denormalised table comes from the records again, so patients and cases are never
    # joined; the order inside each file lets date filters skip row groups.
    counts["base"] = tx.put("base", silver.base().sortWithinPartitions("data_notificacao"))
    gold = gold_tables(tx.table("base"), tx.table("municipios"), tx.table("ufs"), study, restarts=restarts)
    for name, df in gold.items():
        counts[name] = tx.put(name, df)
    tx.commit()
    for name, n in counts.items():
        log.info("%s: %d rows", name, n)
    return counts
