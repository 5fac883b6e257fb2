"""Per-series models that column expressions cannot state: STL and a seasonal regression.

Both run as ``applyInPandas`` over counted weekly series: a group is one series with one row
per calendar week, never raw records, and Spark spreads the series over the tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, GroupedData, functions as F

from epiframe.contracts import HORIZON_WEEKS, SEASON_WEEKS

# Ship these helpers with the task, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _per_series(series: DataFrame, by: Sequence[str]) -> GroupedData:
    """Series grouped for a solver.

    A counted series is few bytes but much work, so the partition count is fixed here: sized
    by bytes, the runtime would put many series into one task.
    """
    slim = series.select(*by, "semana", "casos")
    if not by:
        return slim.withColumn("__one", F.lit(0)).groupBy("__one")
    tasks = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return slim.repartition(tasks, *by).groupBy(*by)


# --- local regression -----------------------------------------------------------------
def loess(y: np.ndarray, span: int, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Degree-one local regression of equally spaced values at positions ``at``.

    ``y`` and ``weights`` hold one series per row. Tricube weights over the ``span`` nearest
    points, times ``weights``; a span longer than the series widens the neighbourhood.
    """
    n = y.shape[1]
    width = min(span, n)
    left = np.clip(np.floor(at - (width - 1) / 2 + 0.5).astype(int), 0, n - width)
    index = left[:, None] + np.arange(width)[None, :]
    gap = np.abs(index - at[:, None])
    reach = np.maximum(gap.max(axis=1), 1e-12) + max(0, (span - n) // 2)
    ratio = gap / reach[:, None]
    near = np.where(ratio <= 0.999, np.where(ratio <= 0.001, 1.0, (1 - ratio**3) ** 3), 0.0)
    w = near[None] * weights[:, index]
    mass = w.sum(axis=2, keepdims=True)
    w = np.divide(w, mass, out=np.full_like(w, 1.0 / width), where=mass > 0)
    centre = (w * index).sum(axis=2, keepdims=True)
    spread = (w * (index - centre) ** 2).sum(axis=2, keepdims=True)
    wide = np.sqrt(spread) > 0.001 * (n - 1)
    tilt = np.divide(at[None, :, None] - centre, spread, out=np.zeros_like(centre), where=wide)
    return (w * (1 + tilt * (index - centre)) * y[:, index]).sum(axis=2)


def _smooth(y: np.ndarray, span: int, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return loess(y[None], span, at, weights[None])[0]


def _smooth_phases(y: np.ndarray, period: int, span: int, weights: np.ndarray) -> np.ndarray:
    """Each position of the period smoothed as a series of its own, one step longer at both
    ends; positions with the same number of points go together."""
    n = len(y)
    out = np.empty(n + 2 * period)
    full = n // period
    for phases, count in ((np.arange(n % period), full + 1), (np.arange(n % period, period), full)):
        if len(phases):
            rows = phases[:, None] + period * np.arange(count)[None, :]
            around = np.arange(-1, count + 1, dtype=float)
            out[phases[:, None] + period * np.arange(count + 2)[None, :]] = loess(y[rows], span, around, weights[rows])
    return out


def _average(x: np.ndarray, k: int) -> np.ndarray:
    sums = np.cumsum(np.concatenate(([0.0], x)))
    return (sums[k:] - sums[:-k]) / k


def _odd(x: float) -> int:
    n = int(np.ceil(x))
    return n if n % 2 else n + 1


def stl(y: np.ndarray, period: int, season_span: int = 7, robust: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Trend and seasonal part after Cleveland, Cleveland, McRae and Terpenning (1990)."""
    n = len(y)
    trend_span = _odd(1.5 * period / (1 - 1.5 / season_span))
    low_span = _odd(period + 1)
    inner, outer = (2, 15) if robust else (5, 0)
    places = np.arange(n, dtype=float)
    ones, weights = np.ones(n), np.ones(n)
    trend, season = np.zeros(n), np.zeros(n)
    for loop in range(outer + 1):
        for _ in range(inner):
            cycle = _smooth_phases(y - trend, period, season_span, weights)
            low = _average(_average(_average(cycle, period), period), 3)
            season = cycle[period : period + n] - _smooth(low, low_span, places, ones)
            trend = _smooth(y - season, trend_span, places, weights)
        if loop < outer:
            rest = np.abs(y - trend - season)
            scale = 6 * np.median(rest)
            ratio = rest / scale if scale > 0 else np.zeros(n)
            weights = np.where(ratio <= 0.001, 1.0, np.where(ratio <= 0.999, (1 - ratio**2) ** 2, 0.0))
    return trend, season


def stl_by_key(series: DataFrame, by: Sequence[str] = (), period: int = SEASON_WEEKS) -> DataFrame:
    """Robust STL of each gap-free weekly series; a series shorter than two periods gets NULLs."""
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in series.schema if f.name in by)
    schema = (keys + ", " if keys else "") + (
        "semana date, casos long, tendencia double, sazonalidade double, residuo double"
    )
    names = list(by)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("semana")
        y = pdf["casos"].to_numpy(dtype=float)
        out = pdf[[*names, "semana", "casos"]].copy()
        if len(y) < 2 * period:
            out["tendencia"] = out["sazonalidade"] = out["residuo"] = np.nan
            return out
        trend, season = stl(y, period)
        out["tendencia"], out["sazonalidade"], out["residuo"] = trend, season, y - trend - season
        return out

    solved = _per_series(series, by).applyInPandas(solve, schema)
    numbers = ("tendencia", "sazonalidade", "residuo")
    return solved.select(*by, "semana", "casos", *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in numbers])


# --- seasonal regression ----------------------------------------------------------------
def design(days: np.ndarray, first: float, length: float, knots: np.ndarray, order: int) -> np.ndarray:
    """Constant, slope, slope changes at the knots and yearly sine/cosine pairs."""
    t = (days - first) / length
    hinges = np.maximum(t[:, None] - knots[None, :], 0.0)
    angle = 2 * np.pi * np.arange(1, order + 1)[None, :] * days[:, None] / 365.25
    return np.column_stack([np.ones_like(t), t, hinges, np.sin(angle), np.cos(angle)])


def forecast_by_key(
    series: DataFrame,
    by: Sequence[str] = (),
    weeks: int = HORIZON_WEEKS,
    order: int = 10,
    changes: int = 25,
    width: float = 0.8,
) -> DataFrame:
    """Additive trend and yearly season per series, for history and the next ``weeks`` weeks.

    A piecewise-linear trend (``changes`` possible bends in the first four fifths) and
    ``order`` yearly harmonics after Taylor and Letham (2018), fitted by ridge regression;
    the interval spans the middle ``width`` of the residuals.
    """
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in series.schema if f.name in by)
    schema = (keys + ", " if keys else "") + "ds date, yhat double, yhat_lower double, yhat_upper double"
    names = list(by)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("semana")
        seen = pd.to_datetime(pdf["semana"])
        ahead = seen.iloc[-1] + pd.to_timedelta(7 * np.arange(1, weeks + 1), unit="D")
        dates = pd.DatetimeIndex(seen).append(pd.DatetimeIndex(ahead))
        days = (dates - pd.Timestamp("1970-01-01")).days.to_numpy(dtype=float)
        y = pdf["casos"].to_numpy(dtype=float)
        n = len(y)
        length = max(days[n - 1] - days[0], 7.0)
        bends = min(changes, max(n // 4, 1))
        knots = np.linspace(0, 0.8, bends + 1)[1:]
        x = design(days, days[0], length, knots, order)
        # Bends are held back harder than harmonics; constant and slope hardly at all.
        penalty = np.concatenate([[1e-8, 1e-8], np.full(bends, 20.0), np.full(2 * order, 0.1)])
        seen_x = x[:n]
        beta = np.linalg.solve(seen_x.T @ seen_x + np.diag(penalty), seen_x.T @ y)
        yhat = x @ beta
        low, high = np.quantile(y - yhat[:n], [(1 - width) / 2, (1 + width) / 2])
        out = pd.DataFrame({"ds": dates.date, "yhat": yhat, "yhat_lower": yhat + low, "yhat_upper": yhat + high})
        for i, name in enumerate(names):
            out.insert(i, name, pdf[name].iloc[0])
        return out

    return _per_series(series, by).applyInPandas(solve, schema)
