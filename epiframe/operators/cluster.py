"""Municipality profiles, scaling, clustering and cluster quality."""

from __future__ import annotations

import sys
import warnings
from collections.abc import Sequence
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from epiframe.contracts import CONFIRMED, DEATH_BY_DISEASE, FEATURES, MIN_CONFIRMED, TRIMESTERS
from epiframe.session import cut_counted, cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1024


def municipality_profile(
    base: DataFrame, municipios: DataFrame, ufs: DataFrame, min_confirmed: int = MIN_CONFIRMED
) -> DataFrame:
    """One row per home municipality with enough confirmed cases.

    Confirmed and notified counts come from one conditional aggregate over all notifications.
    """
    sure = F.col("classificacao_final") == CONFIRMED

    def share(condition):
        return F.try_divide(F.count_if(sure & condition), F.count_if(sure))

    counted = (
        base.filter(F.col("municipio_id").isNotNull())
        .groupBy("municipio_id")
        .agg(
            F.count_if(sure).alias("total_confirmados"),
            F.avg(F.when(sure, F.col("idade_anos"))).alias("idade_media"),
            share(F.col("idade_gestacional").isin(*TRIMESTERS)).alias("pct_gestantes"),
            share(F.col("evolucao_caso") == DEATH_BY_DISEASE).alias("pct_obito"),
            share(F.col("autoctonia") == "Sim").alias("pct_autoctone"),
            F.count("*").alias("total_notificados"),
        )
        .filter(F.col("total_confirmados") >= min_confirmed)
        .withColumn("taxa_confirmacao", F.col("total_confirmados") / F.col("total_notificados"))
    )
    towns = municipios.select("municipio_id", "nome", "uf_id")
    units = F.broadcast(ufs.select("uf_id", "sigla", F.col("nome").alias("uf_nome")))
    joined = counted.join(towns, "municipio_id", "left").join(units, "uf_id", "left")
    return joined.select(*counted.columns, "nome", "uf_id", "sigla", "uf_nome")


def zscores(profile: DataFrame, features: Sequence[str] = FEATURES, prefix: str = "z_") -> DataFrame:
    """Add ``z_<feature>``: missing as 0, population standard deviation, 0 for a constant.

    The profile, one row per municipality, is written first: moments and scores both read it.
    """
    profile = cut_lineage(profile)
    filled = profile.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    moments = filled.agg(
        F.struct(*[F.avg(c).alias(f"m_{c}") for c in features], *[F.stddev_pop(c).alias(f"s_{c}") for c in features]).alias("v")
    ).scalar()
    out = profile.withColumn("__v", moments)
    for c in features:
        off = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.col(f"__v.m_{c}")
        spread = F.col(f"__v.s_{c}")
        out = out.withColumn(prefix + c, F.when(spread > 0, off / spread).otherwise(F.lit(0.0)))
    return out.drop("__v")


def _points(scaled: DataFrame, id_column: str) -> DataFrame:
    """Scaled rows with a hashed id, written once for the many passes that follow.

    The rebalance hint lets the runtime pick few partitions for few municipalities.
    """
    return cut_lineage(scaled.hint("rebalance").withColumn("__h", F.xxhash64(id_column))).persist()


# --- K-means: many runs in one pass ---------------------------------------------------------
def _uniform(h: np.ndarray, salt: int) -> np.ndarray:
    """Repeatable numbers in (0, 1) per row: a retried task draws the same ones."""
    with np.errstate(over="ignore"):
        z = h.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2 * x @ centres.T, 0.0)


def _next_seeds(points: DataFrame, z: list[str], chosen: dict[int, list], step: int, seed: int) -> dict[int, list]:
    """One more centre per run, drawn with probability proportional to the squared distance
    to the centres chosen so far: the row that finishes first in an exponential race."""

    def race(batches):
        best: dict[int, tuple] = {}
        for pdf in batches:
            if pdf.empty:
                continue
            x, h = pdf[z].to_numpy(dtype=float), pdf["__h"].to_numpy()
            for run, centres in chosen.items():
                weight = _squared(x, np.array(centres)).min(1) if centres else np.ones(len(x))
                arrival = -np.log(_uniform(h, seed + 1000 * run + step)) / np.maximum(weight, 1e-300)
                i = int(arrival.argmin())
                if run not in best or arrival[i] < best[run][0]:
                    best[run] = (float(arrival[i]), x[i].tolist())
        if best:  # Arrow takes no type from a list column without rows
            yield pd.DataFrame({"run": list(best), "t": [v[0] for v in best.values()], "x": [v[1] for v in best.values()]})

    winners = points.select("__h", *z).mapInPandas(race, "run int, t double, x array<double>")
    # One row per run.
    return {r["run"]: r["x"] for r in winners.groupBy("run").agg(F.min_by("x", "t").alias("x")).collect()}


def _step(points: DataFrame, z: list[str], centres: dict[int, np.ndarray]) -> dict[int, dict[int, tuple]]:
    """Size, cost and coordinate sums per run and cluster, from one pass over the points."""

    def partial(batches):
        total: dict[tuple[int, int], np.ndarray] = {}
        for pdf in batches:
            x = pdf[z].to_numpy(dtype=float)
            for run, c in centres.items():
                d = _squared(x, c)
                label, near = d.argmin(1), d.min(1)
                for j in np.unique(label):
                    mine = label == j
                    part = np.concatenate([[mine.sum(), near[mine].sum()], x[mine].sum(0)])
                    key = (run, int(j))
                    total[key] = total[key] + part if key in total else part
        if total:
            yield pd.DataFrame(
                {"run": [k[0] for k in total], "cluster": [k[1] for k in total], "n": [v[0] for v in total.values()],
                 "cost": [v[1] for v in total.values()], "s": [v[2:].tolist() for v in total.values()]}
            )

    parts = points.select(*z).mapInPandas(partial, "run int, cluster int, n double, cost double, s array<double>")
    sums = parts.groupBy("run", "cluster").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(len(z))]
    )
    out: dict[int, dict[int, tuple]] = {}
    # One row per run and cluster.
    for r in sums.collect():
        out.setdefault(r["run"], {})[r["cluster"]] = (r["n"], r["cost"], np.array([r[f"s{i}"] for i in range(len(z))]))
    return out


def kmeans(
    points: DataFrame, z: Sequence[str], ks: Sequence[int], restarts: int = 10, seed: int = 42,
    max_iter: int = 300, tol: float = 1e-4,
) -> dict[int, tuple[float, np.ndarray]]:
    """For every ``k`` the inertia and centres of the best of ``restarts`` runs.

    ``points`` has the scaled columns ``z`` and the row hash ``__h``. All runs of all ``k``
    move together: each iteration is a single job in which tasks add up their rows and only
    sums per run and cluster come back, so the number of passes is that of the slowest run.
    """
    z = list(z)
    runs = [k for k in ks for _ in range(restarts)]
    chosen: list[list] = [[] for _ in runs]
    for step in range(max(runs)):
        growing = {run: chosen[run] for run, k in enumerate(runs) if len(chosen[run]) < k}
        for run, centre in _next_seeds(points, z, growing, step, seed).items():
            chosen[run].append(centre)
    centres = {run: np.array(c) for run, c in enumerate(chosen)}
    cost: dict[int, float] = {}
    moving = dict(centres)
    for _ in range(max_iter):
        sums = _step(points, z, moving)
        for run, clusters in sums.items():
            new = centres[run].copy()
            for j, (n, _, s) in clusters.items():
                new[j] = s / n
            cost[run] = sum(c for _, c, _ in clusters.values())
            shift = float(((new - centres[run]) ** 2).sum())
            centres[run] = new
            # The scaled columns have unit variance, which the tolerance is relative to.
            if shift <= tol:
                del moving[run]
            else:
                moving[run] = new
        if not moving:
            break
    else:
        warnings.warn(f"{len(moving)} K-means runs still moved after {max_iter} passes", stacklevel=2)
    for run, clusters in _step(points, z, centres).items():
        cost[run] = sum(c for _, c, _ in clusters.values())
    best: dict[int, tuple[float, np.ndarray]] = {}
    for run, k in enumerate(runs):
        if k not in best or cost[run] < best[k][0]:
            best[k] = (cost[run], centres[run])
    return best


def nearest(z: Sequence[str], centres: np.ndarray) -> Column:
    """Number of the closest centre."""
    ranked = []
    for j, centre in enumerate(centres):
        gaps = [(F.col(c) - F.lit(float(v))) for c, v in zip(z, centre)]
        ranked.append(F.struct(reduce(add, [g * g for g in gaps]).alias("d"), F.lit(j).alias("j")))
    return F.array_min(F.array(*ranked))["j"]


def cluster_municipalities(
    profile: DataFrame, k: int = 4, features: Sequence[str] = FEATURES, restarts: int = 10, seed: int = 42,
    id_column: str = "municipio_id",
) -> DataFrame:
    """Profile plus ``cluster``; clusters are numbered from the largest mean volume down.

    An empty profile gives an empty table.
    """
    z = [f"z_{c}" for c in features]
    points = _points(zscores(profile, features), id_column)
    if points.isEmpty():
        return points.select(*profile.columns, F.lit(0).alias("cluster"))
    _, centres = kmeans(points, z, [k], restarts, seed)[k]
    labelled = points.withColumn("__c", nearest(z, centres))
    size = labelled.groupBy("__c").agg(F.avg("total_confirmados").alias("v"), F.min(id_column).alias("m"))
    # One row per cluster.
    number = F.row_number().over(Window.orderBy(F.desc("v"), "m")) - 1
    numbered = size.select("__c", number.alias("cluster"))
    return labelled.join(F.broadcast(numbered), "__c").select(*profile.columns, "cluster")


def kmeans_sweep(
    profile: DataFrame, id_column: str, ks: Sequence[int] = tuple(range(2, 9)), features: Sequence[str] = FEATURES,
    restarts: int = 10, seed: int = 42,
) -> DataFrame:
    """Inertia and Euclidean silhouette for each ``k``; one distance pass serves them all.

    An empty profile gives an empty table.
    """
    z = [f"z_{c}" for c in features]
    points = _points(zscores(profile, features), id_column)
    if points.isEmpty():
        return points.sparkSession.createDataFrame([], "k int, inercia double, silhueta double")
    best = kmeans(points, z, ks, restarts, seed)
    labelled = points.select(id_column, *z, *[nearest(z, centres).alias(f"k{k}") for k, (_, centres) in best.items()])
    scores = silhouette(labelled, id_column, z, [f"k{k}" for k in ks])
    inertia = points.sparkSession.createDataFrame([(k, float(c)) for k, (c, _) in best.items()], "k int, inercia double")
    return inertia.join(scores.select(F.substring("rotulo", 2, 9).cast("int").alias("k"), "silhueta"), "k")


# --- silhouette -------------------------------------------------------------------------
def silhouette_samples(
    points: DataFrame, id_column: str, features: Sequence[str], labels: Sequence[str], block: int = BLOCK
) -> DataFrame:
    """Euclidean silhouette of every point for every label column: (id, rotulo, silhueta).

    Points are packed into blocks of about ``block`` rows and each pair of blocks is one
    unit of work: the task holds two blocks and sends on one sum per point and cluster, not
    the distances. Memory per task does not depend on the number of points.
    """
    columns, names = [F.col(c).cast("double") for c in features], list(labels)
    slim, total = cut_counted(
        points.select(
            F.col(id_column).alias("id"),
            F.array(*columns).alias("x"),
            F.array(*[F.col(c).cast("int") for c in names]).alias("l"),
        )
    )
    blocks = max(-(-total // block), 1)
    tagged = slim.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    rows = F.collect_list(F.struct("id", "x", "l")).alias("rows")
    packed = tagged.groupBy("b").agg(rows).select(
        "b", F.struct(F.col("rows.id"), F.flatten("rows.x").alias("x"), F.flatten("rows.l").alias("l")).alias("block")
    )
    left = packed.select(
        F.col("block").alias("left"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("b")
    )
    pairs = left.join(packed.select("b", F.col("block").alias("right")), "b").select("left.*", "right.*").toDF(
        "id_a", "x_a", "l_a", "id_b", "x_b", "l_b"
    )
    id_type = points.schema[id_column].dataType.simpleString()

    def sums(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                a, b = np.asarray(row.id_a), np.asarray(row.id_b)
                x_a = np.asarray(row.x_a, dtype=float).reshape(len(a), -1)
                x_b = np.asarray(row.x_b, dtype=float).reshape(len(b), -1)
                own = np.asarray(row.l_a).reshape(len(a), -1)
                other = np.asarray(row.l_b).reshape(len(b), -1)
                distance = np.sqrt(_squared(x_a, x_b))
                _, same_a, same_b = np.intersect1d(a, b, return_indices=True)
                distance[same_a, same_b] = 0.0
                for j, name in enumerate(names):
                    found, position = np.unique(other[:, j], return_inverse=True)
                    member = np.eye(len(found))[position]
                    yield pd.DataFrame(
                        {
                            "id": np.repeat(a, len(found)),
                            "rotulo": name,
                            "own": np.repeat(own[:, j], len(found)),
                            "other": np.tile(found, len(a)),
                            "d": (distance @ member).ravel(),
                            "n": np.tile(member.sum(0).astype(int), len(a)),
                        }
                    )

    schema = f"id {id_type}, rotulo string, own int, other int, d double, n long"
    partial = pairs.mapInPandas(sums, schema)
    per_cluster = partial.groupBy("id", "rotulo", "own", "other").agg(F.sum("d").alias("d"), F.sum("n").alias("n"))
    home = F.col("own") == F.col("other")
    scored = per_cluster.groupBy("id", "rotulo").agg(
        F.max(F.when(home, F.col("n"))).alias("size"),
        F.max(F.when(home & (F.col("n") > 1), F.col("d") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~home, F.col("d") / F.col("n"))).alias("b"),
    )
    top = F.greatest("a", "b")
    value = F.when((F.col("size") == 1) | (top == 0), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / top)
    return scored.select(F.col("id").alias(id_column), "rotulo", value.alias("silhueta"))


def silhouette(points: DataFrame, id_column: str, features: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Mean silhouette per label column."""
    return silhouette_samples(points, id_column, features, labels).groupBy("rotulo").agg(
        F.avg("silhueta").alias("silhueta")
    )


def silhouette_squared(points: DataFrame, id_column: str, features: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Mean silhouette per label column with squared Euclidean distances.

    The mean squared distance of a point to a cluster follows from the cluster's size, sums and squared
    norms, so the work is linear in the points; no pair of them is made. The label columns hold few clusters.
    """
    columns = [F.col(c).cast("double") for c in features]

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)

    marks = F.array(*[F.struct(F.lit(c).alias("rotulo"), F.col(c).cast("int").alias("own")) for c in labels])
    slim = points.select(F.array(*columns).alias("x"), F.explode(marks).alias("l")).select("x", "l.*")
    slim = slim.withColumn("norm", total(F.transform("x", lambda v: v * v)))
    sums = slim.groupBy("rotulo", "own").agg(
        F.count("*").alias("n"), F.sum("norm").alias("norms"),
        F.array(*[F.sum(F.col("x")[i]) for i in range(len(columns))]).alias("sums"))
    clusters = sums.groupBy("rotulo").agg(F.collect_list(F.struct("own", "n", "norms", "sums")).alias("clusters"))
    # One row per label column.
    far = F.transform("clusters", lambda c: F.struct(
        c["own"].alias("own"), c["n"].alias("n"),
        F.greatest(F.col("norm") * c["n"] - 2 * total(F.zip_with("x", c["sums"], lambda a, b: a * b)) + c["norms"], F.lit(0.0)).alias("d")))
    held = slim.join(F.broadcast(clusters), "rotulo").select("rotulo", "own", far.alias("far"))
    home = F.filter("far", lambda c: c["own"] == F.col("own"))[0]
    others = F.filter("far", lambda c: c["own"] != F.col("own"))
    scored = held.select(
        "rotulo", home["n"].alias("size"), F.try_divide(home["d"], home["n"] - 1).alias("a"),
        F.array_min(F.transform(others, lambda c: c["d"] / c["n"])).alias("b"))
    top = F.greatest("a", "b")
    value = F.when((F.col("size") == 1) | (top == 0), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / top)
    return scored.groupBy("rotulo").agg(F.avg(value).alias("silhueta"))


# --- summaries ----------------------------------------------------------------------------
def cluster_profile(clusters: DataFrame, features: Sequence[str] = FEATURES, digits: int = 3) -> DataFrame:
    """Rounded feature means and number of municipalities per cluster."""
    return clusters.groupBy("cluster").agg(
        *[F.round(F.avg(c), digits).alias(c) for c in features], F.count("*").alias("n_municipios")
    )


def covariances(scaled: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """One row, c_<i>_<j> for i <= j: covariances of the scaled features, from one aggregate."""
    z = [f"z_{c}" for c in features]
    # The scaled columns have mean zero, so the mean product is the covariance.
    return scaled.agg(*[F.avg(F.col(z[i]) * F.col(z[j])).alias(f"c_{i}_{j}") for i in range(len(z)) for j in range(i, len(z))])


def pca_scores(profile: DataFrame, features: Sequence[str] = FEATURES, k: int = 2) -> DataFrame:
    """Profile plus ``pca_1 .. pca_k`` on the scaled features.

    The covariance is one aggregate over the rows; only that small matrix is decomposed on
    the driver. Each component points to where its largest loading is positive.
    """
    z = [f"z_{c}" for c in features]
    scaled = zscores(profile, features)
    moments = covariances(scaled, features).first()
    covariance = np.zeros((len(z), len(z)))
    for i in range(len(z)):
        for j in range(i, len(z)):
            covariance[i, j] = covariance[j, i] = moments[f"c_{i}_{j}"] or 0.0
    loadings = np.linalg.eigh(covariance)[1][:, ::-1][:, :k]
    loadings = loadings * np.sign(loadings[np.abs(loadings).argmax(axis=0), range(k)])
    scores = [
        reduce(add, [F.col(c) * float(w) for c, w in zip(z, loadings[:, i])]).alias(f"pca_{i + 1}") for i in range(k)
    ]
    return scaled.select(*profile.columns, *scores)
