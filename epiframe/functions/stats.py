"""Guarded ratios and the significance of a regression slope."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; 0 when the denominator is 0 or NULL."""
    return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))


def percent_change(new: Column, old: Column) -> Column:
    """``(new / old - 1) * 100``; 0 when ``old`` is 0 or NULL."""
    return F.coalesce((F.try_divide(new, old) - 1) * 100, F.lit(0.0))


def t_two_sided_p(t: Column, df: Column) -> Column:
    """Two-sided p-value of Student's t for whole degrees of freedom (closed form)."""
    theta = F.atan(F.abs(t) / F.sqrt(df.cast("double")))
    sin, cos = F.sin(theta), F.cos(theta)
    odd = (df % 2) == 1
    steps = F.floor((df + F.when(odd, -1).otherwise(0)) / 2).cast("int")
    # Terms of the finite series: each is the last one times cos^2 and a ratio of neighbours.
    start = F.struct(
        F.lit(0.0).alias("total"),
        F.when(odd, cos).otherwise(F.lit(1.0)).alias("term"),
    )

    def add(acc: Column, i: Column) -> Column:
        ratio = F.when(odd, 2.0 * i / (2.0 * i + 1.0)).otherwise((2.0 * i - 1.0) / (2.0 * i))
        return F.struct(
            (acc["total"] + acc["term"]).alias("total"),
            (acc["term"] * cos * cos * ratio).alias("term"),
        )

    series = F.when(
        steps >= 1,
        F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), start, add, lambda a: a["total"]),
    ).otherwise(F.lit(0.0))
    inside = F.when(odd, (theta + sin * series) * (2.0 / math.pi)).otherwise(sin * series)
    return F.when(df >= 1, F.greatest(F.lit(1.0) - inside, F.lit(0.0)))
