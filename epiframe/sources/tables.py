"""Parquet and JDBC tables: counted writes, and checked loads into a store of snapshots."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from epiframe.contracts import LOAD_ORDER, SILVER
from epiframe.operators.quality import rule_counts, validate_closures, validate_deaths
from epiframe.plans.silver import Silver
from epiframe.session import cut_lineage, observed
from epiframe.sources.store import Store, Transaction


class ContractError(ValueError):
    """A table breaks its contract; ``violations`` lists (table, column, rule, count)."""

    def __init__(self, violations: list[tuple]):
        self.violations = violations
        super().__init__("; ".join(f"{t}.{c}: {r} ({n})" for t, c, r, n in violations))


def write_counted(df: DataFrame, path: str) -> int:
    """Overwrite ``path`` with ``df``; the row count rides on the write."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return observed(seen).get("n", 0)


def write_tables(tables: Mapping[str, DataFrame], root: str) -> dict[str, int]:
    """One Parquet folder per table under ``root``; returns the row counts."""
    return {name: write_counted(df, f"{root}/{name}") for name, df in tables.items()}


def read_tables(spark: SparkSession, root: str, names: Iterable[str] = LOAD_ORDER) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{root}/{name}") for name in names}


def blank_as_null(df: DataFrame) -> DataFrame:
    """Empty text as NULL, the convention of the relational load."""
    return df.select(
        *[F.nullif(f.name, F.lit("")).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name)
          for f in df.schema.fields]
    )


def violations(tables: Mapping[str, DataFrame], names: Iterable[str] = LOAD_ORDER) -> DataFrame:
    """Violation counts of every contract rule of these tables, zero counts included."""
    return rule_counts(tables, list(names))


#: Rules between two tables that hold rows back from a load: child, its check against the cases.
HELD_BACK = {"casos_encerrados": validate_closures, "obitos": validate_deaths}


def parked(name: str) -> str:
    """The table that keeps rows of ``name`` which a load has held back, with their reason."""
    return f"retidos_{name}"


def stage_silver(tx: Transaction, source: Silver | Mapping[str, DataFrame], strict: bool = True, invalid: str | None = None) -> dict[str, int]:
    """Write the nine tables into a transaction and check them; returns the row counts.

    Parents are written first and, when ``source`` derives the tables, children look them up
    as written. A closure before its notification and a death on a case with another outcome (or one whose case is missing) are
    ``park``ed in a table beside, ``refuse``d with the whole load, or ``keep``t; by default
    parked when ``strict``, else kept. ``strict`` refuses a load in which any contract rule is broken.
    """
    invalid = invalid or ("park" if strict else "keep")
    counts = {}
    for name in LOAD_ORDER:
        df = blank_as_null(source.table(name) if isinstance(source, Silver) else source[name])
        key = SILVER[name].key
        if invalid != "keep" and name in HELD_BACK:
            judged = cut_lineage(HELD_BACK[name](df, tx.table("notificacoes_casos")))
            bad = tx.put(parked(name), judged.filter(F.col("motivo").isNotNull()), key)
            if bad and invalid == "refuse":
                broken = judged.groupBy("motivo").count().filter("motivo IS NOT NULL").collect()  # a row for each of two reasons
                raise ContractError([(name, "notificacao_id", r["motivo"], r["count"]) for r in broken])
            df = judged.filter(F.col("motivo").isNull()).drop("motivo")
        counts[name] = tx.put(name, df, key)
        if isinstance(source, Silver):
            source.replace(name, tx.table(name), counts[name])
    if strict:
        # One row per rule of nine fixed contracts.
        broken = violations({name: tx.table(name) for name in LOAD_ORDER}).filter("n_violacoes > 0").collect()
        if broken:
            raise ContractError([tuple(row) for row in broken])
    return counts


def load_silver(spark: SparkSession, source: Silver | Mapping[str, DataFrame], root: str, strict: bool = True, invalid: str | None = None) -> dict[str, int]:
    """Full refresh of the nine tables as a new snapshot of the store at ``root``.

    Readers see the snapshot only after all tables passed; a refusal (see ``stage_silver``) leaves
    the published one as it was.
    """
    tx = Store(spark, root).begin()
    counts = stage_silver(tx, source, strict, invalid)
    tx.commit()
    return counts


def published(spark: SparkSession, root: str, names: Iterable[str] = LOAD_ORDER) -> dict[str, DataFrame]:
    """Tables of the newest snapshot, all of the same one."""
    now = Store(spark, root).snapshot()
    return {name: now.table(name) for name in names}


def held_back(spark: SparkSession, root: str) -> DataFrame:
    """tabela, id, notificacao_id, motivo of every child row of the newest snapshot; motivo is null for those let in."""
    now = Store(spark, root).snapshot()
    parts = []
    for name in HELD_BACK:
        bad = now.table(parked(name)).select(SILVER[name].key, "notificacao_id", "motivo")
        good = now.table(name).select(SILVER[name].key, "notificacao_id", F.lit(None).cast("string").alias("motivo"))
        parts.append(good.unionByName(bad).select(F.lit(name).alias("tabela"), F.col(SILVER[name].key).alias("id"), "notificacao_id", "motivo"))
    return reduce(DataFrame.unionByName, parts)


def write_bucketed(tables: Mapping[str, DataFrame], database: str, buckets: int = 200) -> None:
    """Cases and patients as tables bucketed by patient, so that joining them needs no shuffle."""
    for name in ("pacientes", "notificacoes_casos"):
        writer = tables[name].write.mode("overwrite").bucketBy(buckets, "paciente_id").sortBy("paciente_id")
        writer.saveAsTable(f"{database}.{name}")


def write_jdbc(tables: Mapping[str, DataFrame], url: str, schema: str = "silver", **properties: str) -> None:
    """Full refresh of the tables in a relational database, parents first."""
    for name in LOAD_ORDER:
        tables[name].write.option("truncate", "true").option("cascadeTruncate", "true").jdbc(
            url, f"{schema}.{name}", mode="overwrite", properties=properties
        )
