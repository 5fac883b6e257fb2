"""Coded ages (unit digit + quantity) and age bands."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from epiframe.contracts import AGE_BANDS, BAND_ORDER, LAST_BAND

# Quantity per year for each unit digit: years, months, days, hours.
UNITS_PER_YEAR = {4: 1, 3: 12, 2: 365, 1: 8760}


def _decode(code: Column, scales: tuple[int, ...], years) -> Column:
    """First branch whose range holds the code: its unit digit and number of digits are fixed
    there, so ``years(quantity, units per year)`` is plain arithmetic."""
    value = code.cast("int")
    out = None
    for scale in scales:
        for digit, per_year in UNITS_PER_YEAR.items():
            inside = (value >= digit * scale) & (value < (digit + 1) * scale)
            result = years(value - digit * scale, per_year)
            out = F.when(inside, result) if out is None else out.when(inside, result)
    return out


def age_years(code: Column) -> Column:
    """Age as DECIMAL(8,2), half-up; NULL for unknown units and codes not of 2 to 4 digits."""
    return _decode(
        code, (1000, 100, 10), lambda q, n: F.round(q.cast("decimal(8,2)") / F.lit(n), 2).cast("decimal(8,2)")
    )


def age_years_double(code: Column) -> Column:
    """Age as DOUBLE rounded to two places; all digits after the first are the quantity."""
    return _decode(code, (1000, 100, 10, 10000), lambda q, n: F.round(q.cast("double") / F.lit(float(n)), 2))


def age_band(age: Column, null_band: str | None = LAST_BAND) -> Column:
    """Band name; a missing age falls into the last band unless ``null_band`` says otherwise."""
    (bound, name), *rest = AGE_BANDS
    out = F.when(age < bound, F.lit(name))
    for bound, name in rest:
        out = out.when(age < bound, F.lit(name))
    return out.when(age.isNull(), F.lit(null_band)).otherwise(F.lit(LAST_BAND))


def band_rank(band: Column) -> Column:
    """Position of a band in age order, from 1."""
    return F.array_position(F.array(*[F.lit(b) for b in BAND_ORDER]), band).cast("int")


def register_age_function(spark: SparkSession) -> None:
    """``idade_anos(code)`` for SQL users; Catalyst inlines the body."""
    text, quantity = "CAST(code AS STRING)", "CAST(substr(CAST(code AS STRING), 2) AS DECIMAL(8,2))"
    units = " ".join(f"WHEN '{digit}' THEN round({quantity} / {per_year}, 2)" for digit, per_year in UNITS_PER_YEAR.items())
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION idade_anos(code SMALLINT) RETURNS DECIMAL(8,2) "
        f"RETURN CASE WHEN code BETWEEN 10 AND 9999 THEN CASE left({text}, 1) {units} END END"
    )
