"""Contract checks as table jobs: each returns the offending rows or counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from epiframe.contracts import BOUNDED_TABLES, DEATH_LABELS, SILVER


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_linhas")).filter("n_linhas > 1")


def check_fk(child: DataFrame, column: str, parent: DataFrame, key: str, bounded: bool = False) -> DataFrame:
    """Non-null child keys without a parent row, with the number of child rows.

    The child is counted per key before the join, so a key with very many rows reaches the
    join as one row.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("chave"))
        .agg(F.count("*").alias("n_linhas"))
    )
    ids = parent.select(F.col(key).alias("chave"))
    return keys.join(F.broadcast(ids) if bounded else ids, "chave", "left_anti")


def fk_breaches(tables: dict[str, DataFrame], names: list[str]) -> DataFrame:
    """tabela, coluna, chave, n_linhas: child keys without a parent row, over all declared references of these tables."""
    return reduce(DataFrame.unionByName, [
        check_fk(tables[name], ref.column, tables[ref.parent], SILVER[ref.parent].key, ref.parent in BOUNDED_TABLES).select(
            F.lit(name).alias("tabela"), F.lit(ref.column).alias("coluna"), F.col("chave").cast("long").alias("chave"), "n_linhas")
        for name in names for ref in SILVER[name].refs
    ])


def _counters(df: DataFrame, table: str, rule: str, tests: dict[str, Column]) -> DataFrame:
    """One (table, column, rule, count) row per test, from a single aggregate over ``df``."""
    counted = df.agg(*[F.count_if(t).alias(c) for c, t in tests.items()])
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).alias("n_violacoes")) for c in tests])
    )
    return counted.select(cells.alias("v")).select(
        F.lit(table).alias("tabela"), "v.coluna", F.lit(rule).alias("regra"), "v.n_violacoes"
    )


def check_not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    return _counters(df, table, "not null", {c: F.col(c).isNull() for c in columns})


def check_length(df: DataFrame, table: str, widths: dict[str, int]) -> DataFrame:
    return _counters(df, table, "length", {c: F.char_length(c) > n for c, n in widths.items()})


RULES = ("not null", "length", "unique", "foreign key")


def contract_breaches(tables: Mapping[str, DataFrame], names: Sequence[str], rules: Sequence[str] = RULES) -> DataFrame:
    """Every breach of these rules in the contracts of these tables: tabela, coluna, regra, chave, n_linhas.

    One pass over each table and one shuffle for all rules. A row gives its keys to the group of (table it
    belongs to, key), once as a row of that table and once for each reference; a group with several rows
    breaks uniqueness, one with references but no row breaks them. Missing and overlong values are
    groups of their own (chave is null). Rows are added up before the shuffle, so a key that very many rows
    share reaches it once a task. A reference to a table that is not given has no rows to point to; several key
    columns are joined by commas; a null key counts as a row of its own kind and is no reference.
    """
    slots: dict[str, list[tuple[str, str]]] = {}
    for name in names:
        for ref in SILVER[name].refs if "foreign key" in rules else ():
            slots.setdefault(ref.parent, []).append((name, ref.column))

    def mark(group: str, column: str, slot: int, key: Column) -> Column:
        return F.struct(F.lit(group).alias("group"), F.lit(column).alias("column"), F.lit(slot).alias("slot"), key.alias("chave"))

    def text(*columns: str) -> Column:
        return F.concat_ws(",", *[F.col(c).cast("string") for c in columns])

    parts = []
    for name in dict.fromkeys([*names, *(p for p in slots if p in tables)]):
        table, marks = SILVER[name], []
        if name in slots or name in names and "unique" in rules:
            marks.append(mark(name, table.key, -1, text(table.key)))
        if name in names and "unique" in rules:
            marks += [mark(name, ",".join(keys), -1, text(*keys)) for keys in table.uniques]
        if name in names and "foreign key" in rules:
            marks += [F.when(F.col(r.column).isNotNull(), mark(r.parent, SILVER[r.parent].key, slots[r.parent].index((name, r.column)), text(r.column))) for r in table.refs]
        none = F.lit(None).cast("string")
        if name in names and "not null" in rules:
            marks += [F.when(F.col(c).isNull(), mark(name, c, -2, none)) for c in table.required]
        if name in names and "length" in rules:
            marks += [F.when(F.char_length(c) > w, mark(name, c, -3, none)) for c, w in table.widths.items()]
        if marks:
            parts.append(tables[name].select(F.explode(F.filter(F.array(*marks), lambda m: m.isNotNull())).alias("m")).select("m.*"))
    most = max(map(len, slots.values()), default=0)
    here = F.when(F.col("slot") < 0, F.col("slot")).otherwise(-1).alias("kind")  # rows and references of a key meet
    counted = reduce(DataFrame.unionByName, parts).groupBy("group", "column", here, "chave").agg(
        F.count_if(F.col("slot") < 0).alias("rows"), *[F.count_if(F.col("slot") == i).alias(f"refs{i}") for i in range(most)])

    own = F.when(F.col("kind") == -2, "not null").when(F.col("kind") == -3, "length")
    if "unique" in rules:
        own = own.when(F.col("rows") > 1, "unique")
    found = [F.when(own.isNotNull() & F.col("group").isin(*names), F.struct(F.col("group").alias("tabela"), F.col("column").alias("coluna"), own.alias("regra"), F.col("rows").alias("n_linhas")))]
    for i in range(most):
        child = F.create_map(*[F.lit(x) for p, refs in slots.items() if i < len(refs) for x in (p, refs[i][0])])
        column = F.create_map(*[F.lit(x) for p, refs in slots.items() if i < len(refs) for x in (p, refs[i][1])])
        lost = (F.col("kind") == -1) & (F.col("rows") == 0) & (F.col(f"refs{i}") > 0)
        found.append(F.when(lost, F.struct(
            child[F.col("group")].alias("tabela"), column[F.col("group")].alias("coluna"), F.lit("foreign key").alias("regra"), F.col(f"refs{i}").alias("n_linhas"))))
    return counted.select("chave", F.explode(F.filter(F.array(*found), lambda b: b.isNotNull())).alias("b")).select(
        "b.tabela", "b.coluna", "b.regra", "chave", "b.n_linhas")


def rule_counts(tables: Mapping[str, DataFrame], names: Sequence[str], rules: Sequence[str] = RULES) -> DataFrame:
    """Violation counts of every rule of these tables, zero counts included: tabela, coluna, regra, n_violacoes.

    Broken uniqueness counts keys, the other rules count rows.
    """
    spark = next(iter(tables.values())).sparkSession
    listed = [
        (n, c, rule) for n in names for rule, columns in (
            ("not null", SILVER[n].required), ("length", SILVER[n].widths),
            ("unique", [",".join(k) for k in ((SILVER[n].key,), *SILVER[n].uniques)]), ("foreign key", [r.column for r in SILVER[n].refs]))
        if rule in rules for c in columns]
    # One row for each rule of the fixed contracts.
    every = spark.createDataFrame(listed, "tabela string, coluna string, regra string")
    size = F.when(F.col("regra") == "unique", F.count(F.lit(1))).otherwise(F.sum("n_linhas"))
    found = contract_breaches(tables, names, rules).groupBy("tabela", "coluna", "regra").agg(size.alias("n"))
    return every.join(found, ["tabela", "coluna", "regra"], "left").select("tabela", "coluna", "regra", F.coalesce("n", F.lit(0)).alias("n_violacoes"))


def validate_closures(closures: DataFrame, cases: DataFrame) -> DataFrame:
    """Closures with a ``motivo`` column: NULL when valid."""
    parents = cases.select("notificacao_id", F.col("data_notificacao").alias("__notified"))
    reason = F.when(F.col("__notified").isNull(), "missing case").when(
        F.col("data_encerramento") < F.col("__notified"), "closure before notification"
    )
    return closures.join(parents, "notificacao_id", "left").select(*closures.columns, reason.alias("motivo"))


def validate_deaths(deaths: DataFrame, cases: DataFrame) -> DataFrame:
    """Deaths with a ``motivo`` column: NULL when the case outcome is a death."""
    parents = cases.select("notificacao_id", F.col("evolucao_caso").alias("__outcome"))
    reason = F.when(F.col("__outcome").isNull(), "missing case").when(
        ~F.col("__outcome").isin(*DEATH_LABELS), "outcome is not a death"
    )
    return deaths.join(parents, "notificacao_id", "left").select(*deaths.columns, reason.alias("motivo"))


def validate_evolution_updates(updates: DataFrame, deaths: DataFrame) -> DataFrame:
    """Outcome updates with a ``motivo`` column.

    A change to an outcome other than death is refused while a death row is linked; NULL
    passes.
    """
    linked = deaths.select("notificacao_id").distinct().withColumn("__dead", F.lit(True))
    reason = F.when(
        ~F.col("evolucao_caso").isin(*DEATH_LABELS) & F.col("__dead"), "linked death row"
    )
    return updates.join(linked, "notificacao_id", "left").select(*updates.columns, reason.alias("motivo"))
