import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from epiframe.operators import cluster, solvers, timeseries, trend

START = dt.date(2018, 1, 1)


def weekly(spark, values, key="a"):
    rows = [(key, START + dt.timedelta(days=7 * i), int(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key string, semana date, casos long")


def seasonal(n, slope=0.2):
    t = np.arange(n)
    return np.round(200 + slope * t + 50 * np.sin(2 * np.pi * t / 52))


def test_gap_week_is_zero_but_not_in_the_profile(spark):
    days = [START, START, START + dt.timedelta(days=15)]
    cases = spark.createDataFrame([(d,) for d in days], "data_primeiros_sintomas date")
    counts = timeseries.weekly_counts(cases)
    assert [r.casos for r in timeseries.fill_weeks(counts).orderBy("semana").collect()] == [2, 0, 1]
    assert {r.semana_epi for r in timeseries.seasonal_profile(counts).collect()} == {1, 3}


def test_study_window_is_inclusive(spark):
    days = ["2017-12-31", "2018-01-01", "2026-06-10", "2026-06-11"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d), "Confirmado") for d in days], "data_primeiros_sintomas date, classificacao_final string")
    assert timeseries.study_cases(df).count() == 2


def test_classical_decomposition_adds_up(spark):
    series = weekly(spark, seasonal(200)).unionByName(weekly(spark, seasonal(170), "b"))
    rows = timeseries.decompose_classical(series, ["key"]).collect()
    inner = [r for r in rows if r.tendencia is not None]
    assert len(rows) == 370 and len(inner) == 370 - 4 * 26
    assert all(r.casos == pytest.approx(r.tendencia + r.sazonalidade + r.residuo) for r in inner)
    assert max(abs(r.residuo) for r in inner) < 3


def test_robust_decomposition_ignores_an_outlier(spark):
    values = seasonal(260)
    values[100] += 1000
    rows = timeseries.decompose_robust(weekly(spark, values).unionByName(weekly(spark, seasonal(30), "b")), ["key"]).orderBy("key", "semana").collect()
    assert all(r.casos == pytest.approx(r.tendencia + r.sazonalidade + r.residuo) for r in rows) and len(rows) == 290
    assert rows[100].residuo > 900 and abs(rows[99].residuo) < 20
    t = np.arange(260)
    assert np.abs(np.array([r.tendencia for r in rows[:260]]) - (200 + 0.2 * t))[26:-26].max() < 5


def test_squared_silhouette_against_brute_force(spark):
    df = blobs(spark).withColumn("half", F.col("municipio_id") % 2).withColumn("lone", (F.col("municipio_id") == 0).cast("int"))
    got = {r.rotulo: r.silhueta for r in cluster.silhouette_squared(df, "municipio_id", ["x", "y"], ["truth", "half", "lone"]).collect()}
    pdf = df.toPandas()
    p = pdf[["x", "y"]].to_numpy()
    d = ((p[:, None] - p[None]) ** 2).sum(-1)
    for name in got:
        labels, each = pdf[name].to_numpy(), []
        for i, own in enumerate(labels):
            same = labels == own
            a = d[i][same].sum() / max(same.sum() - 1, 1)
            b = min(d[i][labels == o].mean() for o in set(labels) - {own})
            each.append(0.0 if same.sum() == 1 else (b - a) / max(a, b))
        assert got[name] == pytest.approx(np.mean(each), abs=1e-9)


def test_stl_recovers_trend_and_season(spark):
    rows = solvers.stl_by_key(weekly(spark, seasonal(260)), ["key"]).orderBy("semana").collect()
    t = np.arange(260)
    assert all(r.casos == pytest.approx(r.tendencia + r.sazonalidade + r.residuo) for r in rows)
    assert np.abs(np.array([r.sazonalidade for r in rows]) - 50 * np.sin(2 * np.pi * t / 52)).max() < 5
    assert np.abs(np.array([r.tendencia for r in rows]) - (200 + 0.2 * t)).max() < 5


def test_stl_ignores_an_outlier(spark):
    values = seasonal(260)
    values[100] += 1000
    rows = solvers.stl_by_key(weekly(spark, values), ["key"]).orderBy("semana").collect()
    assert rows[100].residuo > 900
    assert abs(rows[99].residuo) < 20


def test_short_series_has_no_stl(spark):
    assert solvers.stl_by_key(weekly(spark, seasonal(60))).filter("tendencia IS NOT NULL").count() == 0


@pytest.mark.parametrize("forecaster, error", [(timeseries.forecast_trend_seasonal, 15), (solvers.forecast_by_key, 15)])
def test_forecasts_follow_the_planted_pattern(spark, forecaster, error):
    series = weekly(spark, seasonal(260))
    scores = timeseries.holdout_evaluation(series, forecaster, ["key"]).first()
    assert scores.n_semanas == 12 and scores.mae < error and scores.rmse >= scores.mae
    future = forecaster(series, ["key"], 12)
    assert future.count() == 272
    assert future.filter("yhat_lower > yhat OR yhat_upper < yhat").count() == 0
    assert future.agg(F.max("ds")).first()[0] == START + dt.timedelta(days=7 * 271)


def test_split_and_future(spark):
    series = weekly(spark, range(20))
    parts = timeseries.split_holdout(series, ["key"]).groupBy("conjunto").count().collect()
    assert {r.conjunto: r["count"] for r in parts} == {"treino": 8, "teste": 12}
    assert timeseries.future_weeks(series, ["key"], 3).count() == 23


def test_trend_rules(spark):
    def rows(uf, counts):
        return [(uf, 2018 + i, c) for i, c in enumerate(counts)]

    df = spark.createDataFrame(
        rows("A3", [1, 2, 3]) + rows("LIN", [2, 4, 6, 8]) + rows("CON", [5, 5, 5, 5]) + rows("ANY", [1, 5, 2, 9, 4]),
        "sigla string, ano int, total_casos long")
    got = {r.uf: r for r in trend.yearly_trend(df).collect()}
    assert set(got) == {"LIN", "CON", "ANY"}
    assert (got["LIN"].tendencia_casos_ano, got["LIN"].r2, got["LIN"].p_value) == (pytest.approx(2), pytest.approx(1), pytest.approx(0, abs=1e-6))
    assert (got["CON"].tendencia_casos_ano, got["CON"].r2, got["CON"].p_value) == (0, 0, 1)
    # Slope 1, r² = 100/388, so t = 1.0206 with three degrees of freedom.
    assert got["ANY"].tendencia_casos_ano == pytest.approx(1)
    assert got["ANY"].p_value == pytest.approx(0.38256, abs=1e-5)


def blobs(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c, centre in enumerate([(0, 0), (10, 0), (0, 10), (10, 10)]):
        for i in range(40):
            x, y = rng.normal(centre, 0.5)
            rows.append((c * 1000 + i, float(x), float(y), c, 100 - c))
    return spark.createDataFrame(rows, "municipio_id int, x double, y double, truth int, total_confirmados int")


def test_kmeans_finds_blobs_and_orders_clusters(spark):
    got = cluster.cluster_municipalities(blobs(spark), 4, ["x", "y"])
    table = got.groupBy("truth", "cluster").count().collect()
    assert sorted((r.truth, r.cluster, r["count"]) for r in table) == [(i, i, 40) for i in range(4)]


def test_sweep_prefers_the_true_number(spark):
    rows = {r.k: r for r in cluster.kmeans_sweep(blobs(spark), "municipio_id", range(2, 7), ["x", "y"], restarts=5).collect()}
    assert max(rows, key=lambda k: rows[k].silhueta) == 4
    assert all(rows[k].inercia >= rows[k + 1].inercia for k in range(2, 6))


def test_kmeans_is_as_good_as_the_library(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    scaled = cluster.zscores(blobs(spark), ["x", "y"])
    points = scaled.withColumn("__h", F.xxhash64("municipio_id"))
    ours = cluster.kmeans(points, ["z_x", "z_y"], [3], restarts=5)[3][0]
    vectors = VectorAssembler(inputCols=["z_x", "z_y"], outputCol="features").transform(scaled)
    theirs = min(KMeans(k=3, seed=i).fit(vectors).summary.trainingCost for i in range(5))
    assert ours <= theirs * 1.001


@pytest.mark.parametrize("block", [16, 1024])
def test_silhouette_against_brute_force(spark, block):
    df = blobs(spark).withColumn("half", F.col("municipio_id") % 2).withColumn("lone", (F.col("municipio_id") == 0).cast("int"))
    got = cluster.silhouette_samples(df, "municipio_id", ["x", "y"], ["truth", "half", "lone"], block).collect()
    pdf = df.toPandas()
    p = pdf[["x", "y"]].to_numpy()
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1))
    for name in ("truth", "half", "lone"):
        labels = pdf[name].to_numpy()
        want = {}
        for i, key in enumerate(pdf["municipio_id"]):
            own = labels == labels[i]
            if own.sum() == 1:
                want[key] = 0.0
                continue
            a = d[i][own].sum() / (own.sum() - 1)
            b = min(d[i][labels == o].mean() for o in set(labels) - {labels[i]})
            want[key] = (b - a) / max(a, b)
        ours = {r.municipio_id: r.silhueta for r in got if r.rotulo == name}
        assert ours.keys() == want.keys()
        assert all(ours[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_zscores_of_constants_and_missing(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 1.0, 2.0)], "id int, a double, b double")
    rows = cluster.zscores(df, ["a", "b"]).orderBy("id").collect()
    assert [(r.z_a, r.z_b) for r in rows] == [(0.0, -1.0), (0.0, 1.0)]


def test_pca_matches_svd(spark):
    df = blobs(spark)
    got = cluster.pca_scores(df, ["x", "y"]).orderBy("municipio_id").select("pca_1", "pca_2").toPandas().to_numpy()
    z = df.orderBy("municipio_id").select("x", "y").toPandas().to_numpy()
    z = (z - z.mean(0)) / z.std(0)
    want = z @ np.linalg.svd(z, full_matrices=False)[2].T
    assert np.abs(got) == pytest.approx(np.abs(want), abs=1e-8)


def test_empty_profile_clusters(spark):
    fields = ", ".join(f"{c} double" for c in cluster.FEATURES if c != "total_confirmados")
    profile = spark.createDataFrame([], f"municipio_id int, total_confirmados double, {fields}")
    assert cluster.cluster_municipalities(profile).count() == 0
    assert cluster.kmeans_sweep(profile, "municipio_id").count() == 0
