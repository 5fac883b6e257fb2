"""Weekly series: counting, gap filling, seasonal profile, decomposition, forecast frames.

All functions take ``by``, the columns that tell several series apart (none for a single
one). A counted series has one row per key and calendar week, so a window over one key holds
as many rows as there are weeks, however many records were counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from epiframe.contracts import CONFIRMED, HORIZON_WEEKS, SEASON_WEEKS, STUDY_END, STUDY_START
from epiframe.functions.calendar import between_dates, iso_week, week_start
from epiframe.session import cut_lineage

# Normal quantile of an 80 % interval.
Z80 = 1.2815515655446004


def _window(by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))


def study_cases(cases: DataFrame, first: str = STUDY_START, last: str = STUDY_END) -> DataFrame:
    """Confirmed cases with symptoms inside the study window."""
    return cases.filter(
        (F.col("classificacao_final") == CONFIRMED) & between_dates(F.col("data_primeiros_sintomas"), first, last)
    )


def weekly_counts(cases: DataFrame, by: Sequence[str] = (), date: str = "data_primeiros_sintomas") -> DataFrame:
    """Records per Monday week."""
    return cases.groupBy(*by, week_start(F.col(date)).alias("semana")).agg(F.count("*").alias("casos"))


def fill_weeks(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every Monday between the first and last week of each series; new ones count 0."""
    following = F.lead("semana").over(_window(by).orderBy("semana"))
    spans = series.withColumn("__until", F.coalesce(F.date_sub(following, 7), F.col("semana")))
    weeks = F.sequence(F.col("semana"), F.greatest("semana", "__until"), F.expr("interval 7 days"))
    return spans.select(*by, F.posexplode(weeks).alias("__i", "semana"), "casos").select(
        *by, "semana", F.when(F.col("__i") == 0, F.col("casos")).otherwise(F.lit(0)).alias("casos")
    )


def seasonal_profile(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean weekly count per ISO week over the weeks present; weeks without cases do not count."""
    return series.groupBy(*by, iso_week(F.col("semana")).alias("semana_epi")).agg(
        F.avg("casos").alias("media_casos")
    )


def decompose_classical(series: DataFrame, by: Sequence[str] = (), period: int = SEASON_WEEKS) -> DataFrame:
    """Additive moving-average decomposition of a gap-free series.

    The trend is the centred moving average over one period (half weights at both ends for
    an even period) and NULL where the window is incomplete; the seasonal figure of a week is
    the mean detrended value of its position in the period, centred on zero.
    """
    window = _window(by).orderBy("semana")
    half = period // 2
    wide = window.rowsBetween(-half, half)
    full = F.count("*").over(wide) == 2 * half + 1
    if period % 2 == 0:
        inner = window.rowsBetween(-half + 1, half - 1)
        mean = (F.sum("casos").over(wide) + F.sum("casos").over(inner)) / (2.0 * period)
    else:
        mean = F.sum("casos").over(wide) / float(period)
    trended = series.withColumn("tendencia", F.when(full, mean)).withColumn(
        "__pos", (F.row_number().over(window) - 1) % period
    )
    detrended = F.col("casos") - F.col("tendencia")
    phase = Window.partitionBy(*by, "__pos")
    raw = trended.withColumn("__season", F.avg(detrended).over(phase))
    # Centre on the mean of the period's positions, each position counted once.
    once = F.when(F.row_number().over(Window.partitionBy(*by, "__pos").orderBy("semana")) == 1, F.col("__season"))
    centred = raw.withColumn("__once", once).withColumn(
        "sazonalidade", F.col("__season") - F.avg("__once").over(_window(by))
    )
    return centred.select(
        *by, "semana", "casos", "tendencia", "sazonalidade",
        (F.col("casos") - F.col("tendencia") - F.col("sazonalidade")).alias("residuo"),
    )


def decompose_robust(
    series: DataFrame, by: Sequence[str] = (), period: int = SEASON_WEEKS, rounds: int = 3
) -> DataFrame:
    """Additive decomposition of a gap-free series that outliers don't bend.

    The trend is a weighted straight line over one period around each week (half weights at both ends of an
    even period; at the ends of the series over the weeks there are) through what the season of the round
    before leaves, the seasonal figure the weighted mean
    detrended value of a week's position, centred on zero. Each of ``rounds`` times the weeks are weighted
    anew by the bisquare of their residual over six median absolute residuals. Series of any length get all
    parts; the trend is NULL only where all weeks around have no weight.
    """
    order, every = _window(by).orderBy("semana"), _window(by)
    half, phase = period // 2, Window.partitionBy(*by, "__pos")

    def around(value: Column) -> Column:
        full = F.sum(value).over(order.rowsBetween(-half, half))
        if period % 2:
            return full
        return (full + F.sum(value).over(order.rowsBetween(1 - half, half - 1))) / 2

    w, x, y = F.col("__w"), F.col("__x"), F.col("casos").cast("double")
    bare = y - F.col("sazonalidade")
    out = series.select(*by, "semana", "casos", F.row_number().over(order).cast("double").alias("__x"), F.lit(1.0).alias("__w"),
                        F.lit(0.0).alias("sazonalidade"))
    out = out.withColumn("__pos", (F.col("__x") - 1) % period)
    first = F.row_number().over(phase.orderBy("semana")) == 1
    for _ in range(rounds + 1):
        out = out.withColumns({"__m": around(w), "__mx": around(w * x), "__mxx": around(w * x * x), "__my": around(w * bare), "__mxy": around(w * x * bare)})
        spread = F.col("__m") * F.col("__mxx") - F.col("__mx") * F.col("__mx")
        tilt = F.when(spread > 1e-6, (F.col("__m") * F.col("__mxy") - F.col("__mx") * F.col("__my")) / spread).otherwise(F.lit(0.0))
        out = out.withColumn("tendencia", F.try_divide("__my", "__m") + tilt * (x - F.try_divide("__mx", "__m")))
        mean = F.try_divide(F.sum(w * (y - F.col("tendencia"))).over(phase), F.sum(w).over(phase))
        out = out.withColumn("__season", F.coalesce(mean, F.lit(0.0))).withColumn("__once", F.when(first, F.col("__season")))
        out = out.withColumn("sazonalidade", F.col("__season") - F.avg("__once").over(every))
        out = out.withColumn("residuo", y - F.col("tendencia") - F.col("sazonalidade"))
        out = out.withColumn("__scale", 6 * F.median(F.abs("residuo")).over(every))
        off = F.abs("residuo") / F.col("__scale")
        fresh = F.when(F.col("__scale") <= 1e-9, F.lit(1.0)).when(off < 1, (1 - off * off) * (1 - off * off)).otherwise(F.lit(0.0))
        out = out.withColumn("__w", fresh)
    return out.select(*by, "semana", "casos", "tendencia", "sazonalidade", "residuo")


# --- holdout and future ------------------------------------------------------------------
def _last(by: Sequence[str]) -> Column:
    return F.max("semana").over(_window(by))


def split_holdout(series: DataFrame, by: Sequence[str] = (), weeks: int = HORIZON_WEEKS) -> DataFrame:
    """``conjunto`` = 'treino' for all but the last ``weeks`` weeks, which are 'teste'."""
    cut = F.date_sub(_last(by), 7 * weeks)
    return series.withColumn("conjunto", F.when(F.col("semana") > cut, "teste").otherwise("treino"))


def future_weeks(series: DataFrame, by: Sequence[str] = (), weeks: int = HORIZON_WEEKS) -> DataFrame:
    """History plus the next ``weeks`` Mondays of each series, as column ``ds``."""
    ends = series.groupBy(*by).agg(F.min("semana").alias("a"), F.max("semana").alias("b"))
    span = F.sequence("a", F.date_add("b", 7 * weeks), F.expr("interval 7 days"))
    return ends.filter(F.col("b").isNotNull()).select(*by, F.explode(span).alias("ds"))


def forecast_trend_seasonal(
    series: DataFrame, by: Sequence[str] = (), weeks: int = HORIZON_WEEKS, z: float = Z80
) -> DataFrame:
    """Straight-line trend plus mean deviation per ISO week, for history and future.

    Returns ``ds, yhat, yhat_lower, yhat_upper``; the interval is ``z`` residual standard
    deviations wide on each side.
    """
    every = _window(by)
    origin = F.min("semana").over(every)
    x = (F.datediff("semana", origin) / 7).cast("double")
    y = F.col("casos").cast("double")
    fitted = (
        series.withColumn("__x", x)
        .withColumn("__slope", F.coalesce(F.try_divide(F.covar_pop("__x", y).over(every), F.var_pop("__x").over(every)), F.lit(0.0)))
        .withColumn("__level", F.avg(y).over(every) - F.col("__slope") * F.avg("__x").over(every))
        .withColumn("__week", iso_week(F.col("semana")))
        .withColumn("__off", y - F.col("__level") - F.col("__slope") * F.col("__x"))
        .withColumn("__season", F.avg("__off").over(Window.partitionBy(*by, "__week")))
        .withColumn("__sd", F.stddev_pop(F.col("__off") - F.col("__season")).over(every))
    )
    lines = fitted.groupBy(*by).agg(
        F.min("semana").alias("__a"),
        F.max("semana").alias("__b"),
        F.max("__slope").alias("__slope"),
        F.max("__level").alias("__level"),
        F.max("__sd").alias("__sd"),
        # At most 53 entries: one per ISO week.
        F.map_from_entries(F.collect_set(F.struct("__week", "__season"))).alias("__seasons"),
    )
    span = F.sequence("__a", F.date_add("__b", 7 * weeks), F.expr("interval 7 days"))
    points = lines.filter(F.col("__b").isNotNull()).select("*", F.explode(span).alias("ds"))
    season = F.coalesce(F.try_element_at("__seasons", iso_week(F.col("ds"))), F.lit(0.0))
    yhat = F.col("__level") + F.col("__slope") * F.datediff("ds", "__a") / 7 + season
    return points.select(*by, "ds", yhat.alias("yhat"), "__sd").select(
        *by, "ds", "yhat",
        (F.col("yhat") - z * F.col("__sd")).alias("yhat_lower"),
        (F.col("yhat") + z * F.col("__sd")).alias("yhat_upper"),
    )


def evaluate(forecast: DataFrame, actual: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute and root mean squared error over the weeks of ``actual``."""
    truth = actual.select(*by, F.col("semana").alias("ds"), F.col("casos").alias("__y"))
    error = F.col("__y") - F.col("yhat")
    joined = forecast.join(truth, [*by, "ds"])
    return joined.groupBy(*by).agg(
        F.count("*").alias("n_semanas"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


def holdout_evaluation(series: DataFrame, forecaster, by: Sequence[str] = (), weeks: int = HORIZON_WEEKS) -> DataFrame:
    """Error of ``forecaster`` on the last ``weeks`` weeks after fitting on the rest.

    The series, one row per key and week, is written first: both parts read it.
    """
    series = cut_lineage(series)
    parts = split_holdout(series, by, weeks)
    train = parts.filter(F.col("conjunto") == "treino").drop("conjunto")
    test = parts.filter(F.col("conjunto") == "teste").drop("conjunto")
    return evaluate(forecaster(train, by, weeks), test, by)
