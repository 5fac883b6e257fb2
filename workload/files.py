"""Registered questions on files and published tables: raw text in, snapshots out.

The derived records are first written as the files a user would bring (a case file with the raw header, a
gazetteer with title lines), then read by the library's own readers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from epiframe.contracts import CASE_COLUMNS, LOAD_ORDER
from epiframe.operators import audit
from epiframe.plans import views
from epiframe.plans.run import run
from epiframe.sources.bronze import read_case_file, read_gazetteer
from epiframe.sources.tables import blank_as_null, load_silver, published
from workload import model
from workload.model import STUDY, table
from workload.queries import _LATER, _SUMMARY, _VERSION, ORACLES, _scratch, query

_TEXTS = [c for c in model.BRONZE if c != "row_id"]
_BLANKED = ", ".join(f"nullif({c}, '') AS {c}" for c in _TEXTS)
_TITLES = 6


def write_case_file(spark: SparkSession, sf: str, path: str) -> None:
    """The derived records as CSV files under the raw header, in the order of their numbers, with a column nobody asks for."""
    orders = table(spark, sf, "orders")  # put in order before their few columns become the many of a record
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ordered = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate").repartitionByRange(ranges, "o_orderkey").sortWithinPartitions("o_orderkey")
    named = model.records(ordered).select(F.lit("x").alias("extra"), *[F.col(new).alias(old) for old, new in CASE_COLUMNS.items()])
    named.write.options(header=True, emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_gazetteer(spark: SparkSession, sf: str, path: str) -> None:
    """The derived municipalities as one CSV file: title lines, the header, then a line each (no more than there are towns)."""
    head = [f"title {i}" for i in range(_TITLES)] + ["UF,Nome_UF,Região,Código Município Completo,Nome_Município"]
    top = spark.createDataFrame([(i, line) for i, line in enumerate(head)], "place int, value string")
    towns = model.gazetteer(spark, sf).distinct()
    body = towns.select(F.lit(len(head)).alias("place"), F.concat_ws(",", "uf_code", "uf_nome", F.lit("r"), "municipio_id", "municipio_nome").alias("value"))
    top.unionByName(body).coalesce(1).sortWithinPartitions("place", "value").select("value").write.text(path)


@query("case_file", f"SELECT row_number() OVER (ORDER BY row_id) AS row_id, {_BLANKED} FROM bronze")
def _(spark, sf):
    path = _scratch(spark, "cases")
    write_case_file(spark, sf, path)
    return read_case_file(spark, path)


@query("gazetteer_file", "SELECT DISTINCT * FROM gaz")
def _(spark, sf):
    path = _scratch(spark, "towns")
    write_gazetteer(spark, sf, path)
    return read_gazetteer(spark, path, _TITLES)


@query("blank_text", f"SELECT row_id, {_BLANKED} FROM bronze")
def _(spark, sf):
    return blank_as_null(model.bronze(spark, sf))


@query(
    "full_refresh_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS tabela, count(*) AS n_gravadas, count(*) AS n_lidas, 0 AS textos_vazios FROM {n}" for n in LOAD_ORDER),
)
def _(spark, sf):
    """Counts that ride on the second of two loads, next to those of the tables read back; no empty text comes through."""
    root, source = _scratch(spark, "refresh"), model.silver(spark, sf).settle()
    load_silver(spark, source.tables(), root, strict=False)
    counts = load_silver(spark, source.tables(), root, strict=False)
    parts = []
    for name, df in published(spark, root).items():
        texts = [F.col(f.name) == "" for f in df.schema.fields if f.dataType.simpleString() == "string"]
        blank = F.coalesce(F.count_if(reduce(lambda a, b: a | b, texts, F.lit(False))), F.lit(0)).cast("int")
        parts.append(df.agg(F.count("*").alias("n_lidas"), blank.alias("textos_vazios")).select(
            F.lit(name).alias("tabela"), F.lit(counts[name]).cast("long").alias("n_gravadas"), "n_lidas", "textos_vazios"))
    return reduce(DataFrame.unionByName, parts)


@query(
    "run_gold",
    f"""SELECT 'tendencia_casos_uf' AS tabela, uf AS chave, round(tendencia_casos_ano, 6) AS valor FROM trend
        UNION ALL SELECT 'perfil_sazonal_semana_epi', CAST(semana_epi AS VARCHAR), round(media_casos, 6) FROM profile_week
        UNION ALL SELECT 'base', sigla, CAST(count(*) AS DOUBLE) FROM base GROUP BY sigla""",
    series="whole",
)
def _(spark, sf):
    """The whole run, from the files to the snapshot: two gold tables and the base as published."""
    root = _scratch(spark, "run")
    write_case_file(spark, sf, f"{root}/cases")
    write_gazetteer(spark, sf, f"{root}/towns")
    run(spark, f"{root}/cases", f"{root}/towns", f"{root}/bronze", f"{root}/store", STUDY, strict=False, gazetteer_skip=_TITLES, restarts=2)
    t = published(spark, f"{root}/store", ["tendencia_casos_uf", "perfil_sazonal_semana_epi", "base"])

    def part(name: str, key: str, value) -> DataFrame:
        return t[name].select(F.lit(name).alias("tabela"), F.col(key).cast("string").alias("chave"), F.round(value, 6).alias("valor"))

    t["base"] = t["base"].groupBy("sigla").agg(F.count("*").cast("double").alias("n"))
    return reduce(DataFrame.unionByName, [
        part("tendencia_casos_uf", "uf", "tendencia_casos_ano"), part("perfil_sazonal_semana_epi", "semana_epi", "media_casos"), part("base", "sigla", "n")])


def _registered(spark: SparkSession, sf: str) -> None:
    views.register_views(spark, model.silver(spark, sf).settle().tables())


ORACLES["sql_view_uf_year"] = ORACLES["view_uf_year"]


@query("sql_view_uf_year")
def _(spark, sf):
    _registered(spark, sf)
    return spark.sql("SELECT uf, ano, total_casos FROM vw_casos_uf_ano")


@query(
    "sql_summary_function",
    " UNION ALL ".join(
        f"""SELECT '{mode}' AS modo, m.uf_id AS uf_codigo, CAST(year(n.data_notificacao) AS INTEGER) AS ano, count(*) AS total_casos
            FROM notificacoes_casos n {joins} WHERE n.classificacao_final = 'Confirmado' GROUP BY 2, 3"""
        for mode, joins in _SUMMARY.items()
    ),
)
def _(spark, sf):
    _registered(spark, sf)
    return spark.sql(" UNION ALL ".join(f"SELECT '{mode}' AS modo, * FROM resumo_epidemiologico_uf_ano('{mode}')" for mode in _SUMMARY))


@query(
    "audit_stamps",
    """SELECT CASE WHEN o.notificacao_id IS NULL THEN 'INSERT' WHEN n.notificacao_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operacao,
              count(*) AS n_linhas, count(*) AS com_usuario, count(*) AS com_hora, 1 AS horas
       FROM notificacoes_casos o FULL OUTER JOIN later n ON n.notificacao_id = o.notificacao_id
       WHERE o.notificacao_id IS NULL OR n.notificacao_id IS NULL OR o.classificacao_final <> n.classificacao_final GROUP BY 1""",
    later=_LATER.format(old="notificacoes_casos", customer="customer"),
)
def _(spark, sf):
    """Every log row carries the session's user and the one time of its statement."""
    old = model.silver(spark, sf).notificacoes_casos(*_VERSION)
    new = spark.sql(_LATER, old=old, customer=table(spark, sf, "customer"))
    log = audit.audit_diff(old, new, "notificacao_id", "silver", "notificacoes_casos")
    recent = F.col("data_hora").between(F.current_timestamp() - F.expr("interval 1 hour"), F.current_timestamp())
    return log.groupBy("operacao").agg(
        F.count("*").alias("n_linhas"), F.count_if(F.col("usuario_banco") == F.current_user()).alias("com_usuario"),
        F.count_if(recent).alias("com_hora"), F.count_distinct("data_hora").cast("int").alias("horas"))
