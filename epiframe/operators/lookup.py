"""Key resolution against dimension tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

#: A lookup table known to have up to this many rows (a short key and one value each) is broadcast.
BROADCAST_ROWS = 2_000_000


def sized(dim: DataFrame, rows: int | None) -> DataFrame:
    """``dim``, to be broadcast if its number of rows is known and small; else the engine chooses."""
    return F.broadcast(dim) if rows is not None and rows <= BROADCAST_ROWS else dim


def unique_lookup(dim: DataFrame, key: Column, value: str) -> DataFrame:
    """(``key``, ``value``) with one row per key; a key with several values is marked.

    The mark turns into an error only when a row really asks for that key, which is what a
    scalar subquery does.
    """
    return (
        dim.select(key.alias("key"), F.col(value).alias("value"))
        .groupBy("key")
        .agg(F.min("value").alias("value"), F.count("*").alias("n"))
    )


def resolve_unique(df: DataFrame, out: str, key: Column, lookup: DataFrame, rows: int | None = None) -> DataFrame:
    """Add ``out``: the value of ``unique_lookup`` for ``key``, NULL when there is none; ``rows``: its size, if known."""
    found = lookup.select(
        F.col("key").alias("__key"), F.col("value").alias("__value"), F.col("n").alias("__n")
    )
    value = F.when(
        F.col("__n") > 1,
        F.raise_error(F.concat(F.lit("more than one match for key "), F.col("__key"))),
    ).otherwise(F.col("__value"))
    return (
        df.join(sized(found, rows), key == F.col("__key"), "left")
        .withColumn(out, value)
        .drop("__key", "__value", "__n")
    )


def resolve(df: DataFrame, out: str, on: dict[str, Column], dim: DataFrame, value: str, rows: int | None = None) -> DataFrame:
    """Add ``out``: ``value`` of the row of a uniquely keyed ``dim``; NULL if none. ``rows``: its size, if known."""
    names = {k: f"__{out}_{k}" for k in on}
    side = dim.select(*[F.col(k).alias(n) for k, n in names.items()], F.col(value).alias(out))
    match = reduce(and_, [on[k] == F.col(n) for k, n in names.items()])
    return df.join(sized(side, rows), match, "left").drop(*names.values())


def resolve_large(df: DataFrame, out: str, key: Column, dim: DataFrame, dim_key: str) -> DataFrame:
    """Add ``out``: ``key`` where ``dim`` has it, else NULL, for a uniquely keyed dimension of any size.

    A key or NULL that holds a large share of the rows makes a large partition on the left, which
    adaptive execution parts among tasks.
    """
    probe = df.withColumn("__probe", key)
    known = dim.select(F.col(dim_key).alias(out))
    return probe.join(known, F.col("__probe") == F.col(out), "left").drop("__probe")
