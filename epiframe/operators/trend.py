"""Yearly trend per unit of infection with its significance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from epiframe.functions.stats import t_two_sided_p


def regression(y: Column, x: Column) -> dict[str, Column]:
    """Aggregates of a least-squares line: slope, squared correlation and sample size.

    A constant ``y`` has no correlation.
    """
    flat = F.var_pop(y.cast("double")) == 0
    return {
        "slope": F.regr_slope(y, x),
        "r2": F.when(flat, F.lit(0.0)).otherwise(F.regr_r2(y, x)),
        "n": F.count("*"),
    }


def slope_p_value(r2: Column, n: Column) -> Column:
    """Two-sided p-value of the slope, with n - 2 degrees of freedom."""
    df = n - 2
    t = F.sqrt(F.try_divide(r2 * df, F.lit(1.0) - r2))
    return F.when(r2 >= 1.0, F.lit(0.0)).when(r2 == 0.0, F.lit(1.0)).otherwise(t_two_sided_p(t, df))


def cases_per_uf_year(cases: DataFrame, ufs: DataFrame) -> DataFrame:
    """Cases by unit of infection and notification year; years without cases are absent."""
    counts = (
        cases.filter(F.col("uf_provavel_infeccao").isNotNull())
        .groupBy("uf_provavel_infeccao", F.year("data_notificacao").alias("ano"))
        .agg(F.count("*").alias("total_casos"))
    )
    names = ufs.select(F.col("uf_id").alias("uf_provavel_infeccao"), "sigla", "nome")
    return counts.join(F.broadcast(names), "uf_provavel_infeccao", "left")


def yearly_trend(uf_years: DataFrame, min_years: int = 4) -> DataFrame:
    """Slope, r² and p-value of cases by year for units with enough years of data."""
    known = uf_years.filter(F.col("ano").isNotNull() & F.col("sigla").isNotNull())
    line = regression(F.col("total_casos"), F.col("ano"))
    fitted = (
        known.groupBy(F.col("sigla").alias("uf"))
        .agg(
            F.count("*").alias("anos_com_dados"),
            F.sum("total_casos").alias("total_casos"),
            line["slope"].alias("tendencia_casos_ano"),
            line["r2"].alias("r2"),
        )
        .filter(F.col("anos_com_dados") >= min_years)
    )
    return fitted.withColumn("p_value", slope_p_value(F.col("r2"), F.col("anos_com_dados")))


def largest(trend: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` units with most cases overall."""
    return trend.orderBy(F.desc("total_casos"), "uf").limit(k)
