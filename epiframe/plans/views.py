"""The standing views and the yearly summary over the silver tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from epiframe.contracts import CONFIRMED, DEATH_BY_DISEASE, SEXES, TRIMESTERS, UNDER_INVESTIGATION
from epiframe.functions.age import age_band, age_years, register_age_function


def _confirmed(cases: DataFrame) -> DataFrame:
    return cases.filter(F.col("classificacao_final") == CONFIRMED)


def weekly_series(cases: DataFrame) -> DataFrame:
    """Confirmed cases by year of symptoms and epidemiological week."""
    return (
        _confirmed(cases)
        .groupBy(F.year("data_primeiros_sintomas").alias("ano"), "semana_primeiros_sintomas")
        .agg(F.count("*").alias("total_casos"))
    )


def uf_year(cases: DataFrame, ufs: DataFrame) -> DataFrame:
    """Confirmed cases by unit of infection and year of notification."""
    counts = (
        _confirmed(cases)
        .filter(F.col("uf_provavel_infeccao").isNotNull())
        .groupBy("uf_provavel_infeccao", F.year("data_notificacao").alias("ano"))
        .agg(F.count("*").alias("total_casos"))
    )
    names = F.broadcast(ufs.select(F.col("uf_id").alias("uf_provavel_infeccao"), F.col("sigla").alias("uf")))
    return counts.join(names, "uf_provavel_infeccao").select("uf", "ano", "total_casos")


def age_pyramid(cases: DataFrame, patients: DataFrame) -> DataFrame:
    """Confirmed cases by age band and sex."""
    people = patients.filter(F.col("sexo").isin(*SEXES)).select("paciente_id", "sexo", "idade_codificada")
    joined = _confirmed(cases).select("paciente_id").join(people, "paciente_id")
    return joined.groupBy(age_band(age_years(F.col("idade_codificada"))).alias("faixa_etaria"), "sexo").agg(
        F.count("*").alias("total_casos")
    )


def pregnancy(patients: DataFrame) -> DataFrame:
    """Patients by trimester, whatever the classification of their case."""
    return (
        patients.filter(F.col("idade_gestacional").isin(*TRIMESTERS))
        .groupBy("idade_gestacional")
        .agg(F.count("*").alias("total_casos"))
    )


def kpis(cases: DataFrame, patients: DataFrame) -> DataFrame:
    """One row over all notifications; the sums are NULL when there are none."""

    def total(condition):
        return F.sum(F.when(condition, 1).otherwise(0))

    joined = cases.select("paciente_id", "evolucao_caso", "classificacao_final").join(
        patients.select("paciente_id", "idade_gestacional"), "paciente_id"
    )
    return joined.agg(
        F.count("*").alias("total_casos"),
        total(F.col("evolucao_caso") == DEATH_BY_DISEASE).alias("total_obitos"),
        total(F.col("idade_gestacional").isin(*TRIMESTERS)).alias("total_gestantes"),
        total(F.col("classificacao_final") == UNDER_INVESTIGATION).alias("aguardando_investigacao"),
    )


SUMMARY_MODES = ("NOTIFICACAO", "RESIDENCIA", "INFECCAO")


def uf_year_summary(mode: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Confirmed cases by unit and year; the mode says which unit: that of the notifying
    unit, of residence or of infection.

    Cases are counted per foreign key before the dimension join, so what is joined has one
    row per key and year.
    """
    chosen = mode.upper()
    if chosen not in SUMMARY_MODES:
        raise ValueError(f"unknown mode {mode!r}; use one of {', '.join(SUMMARY_MODES)}")
    cases = _confirmed(tables["notificacoes_casos"])
    year = F.year("data_notificacao").alias("ano")
    if chosen == "INFECCAO":
        per_uf = cases.filter(F.col("uf_provavel_infeccao").isNotNull()).select(
            F.col("uf_provavel_infeccao").alias("uf_codigo"), year, "notificacao_id"
        )
        return per_uf.groupBy("uf_codigo", "ano").agg(F.count("notificacao_id").alias("total_casos"))

    if chosen == "NOTIFICACAO":
        per_key = cases.groupBy("unidade_id", year).agg(F.count("notificacao_id").alias("n"))
        units = tables["unidades_notificadoras"].select("unidade_id", "municipio_id")
        placed = per_key.join(units, "unidade_id")
    else:
        people = tables["pacientes"].select("paciente_id", "municipio_id")
        joined = cases.select("paciente_id", "data_notificacao", "notificacao_id").join(people, "paciente_id")
        placed = joined.groupBy("municipio_id", year).agg(F.count("notificacao_id").alias("n"))
    towns = F.broadcast(tables["municipios"].select("municipio_id", F.col("uf_id").alias("uf_codigo")))
    return (
        placed.join(towns, "municipio_id").groupBy("uf_codigo", "ano").agg(F.sum("n").alias("total_casos"))
    )


def newest_first(summary: DataFrame) -> DataFrame:
    """Reading order of the summary: latest year, then most cases."""
    return summary.orderBy(F.desc("ano"), F.desc("total_casos"))


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Silver tables and standing views as temp views, and the summary as a SQL table
    function, for SQL users of this session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    cases, patients = tables["notificacoes_casos"], tables["pacientes"]
    views = {
        "vw_serie_temporal_semanal": weekly_series(cases).orderBy(
            F.asc_nulls_last("ano"), F.asc_nulls_last("semana_primeiros_sintomas")
        ),
        "vw_casos_uf_ano": uf_year(cases, tables["ufs"]).orderBy(F.asc_nulls_last("ano")),
        "vw_piramide_etaria": age_pyramid(cases, patients).orderBy("faixa_etaria", "sexo"),
        "vw_vigilancia_gestantes": pregnancy(patients),
        "vw_kpis": kpis(cases, patients),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    register_age_function(spark)
    for mode in SUMMARY_MODES:
        uf_year_summary(mode, tables).createOrReplaceTempView(f"resumo_{mode.lower()}")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION resumo_epidemiologico_uf_ano(tipo_uf STRING)
        RETURNS TABLE (uf_codigo SMALLINT, ano INT, total_casos BIGINT)
        RETURN
          SELECT uf_codigo, ano, total_casos FROM (
            SELECT 'NOTIFICACAO' AS modo, * FROM resumo_notificacao
            UNION ALL SELECT 'RESIDENCIA', * FROM resumo_residencia
            UNION ALL SELECT 'INFECCAO', * FROM resumo_infeccao
          ) WHERE modo = CASE
              WHEN upper(tipo_uf) IN ('NOTIFICACAO', 'RESIDENCIA', 'INFECCAO') THEN upper(tipo_uf)
              ELSE raise_error('unknown mode: ' || tipo_uf) END
    """)
