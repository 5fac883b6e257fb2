"""The five statistics tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from epiframe.contracts import STUDY_END, STUDY_START
from epiframe.operators import cluster, timeseries, trend


def gold_tables(
    base: DataFrame, municipios: DataFrame, ufs: DataFrame, study: tuple[str, str] = (STUDY_START, STUDY_END),
    k: int = 4, restarts: int = 10,
) -> dict[str, DataFrame]:
    """Decomposition, seasonal profile, trend, forecast and municipality clusters.

    ``base`` is the denormalised case table. Everything but the clusters looks at confirmed
    cases in the study window; the clusters at all notifications.
    """
    cases = timeseries.study_cases(base, *study)
    observed = timeseries.weekly_counts(cases)
    weekly = timeseries.fill_weeks(observed)
    by_year = trend.cases_per_uf_year(cases.select("uf_provavel_infeccao", "data_notificacao"), ufs)
    profile = cluster.municipality_profile(base, municipios, ufs)
    return {
        "sazonalidade_semanal": timeseries.decompose_robust(weekly),
        "perfil_sazonal_semana_epi": timeseries.seasonal_profile(observed),
        "tendencia_casos_uf": trend.yearly_trend(by_year),
        "previsao_casos_semanal": timeseries.forecast_trend_seasonal(weekly),
        "clusters_municipios": cluster.cluster_municipalities(profile, k, restarts=restarts),
    }
