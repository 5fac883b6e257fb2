import datetime as dt
import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from epiframe.functions import age, calendar, clean, stats


def one(spark, values, type_name, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_name}")
    return [tuple(r) for r in df.orderBy("i").select(*exprs).collect()]


def test_nullify(spark):
    got = one(spark, ["", " ", "/N", " /N ", " a ", None], "string", clean.nullify(F.col("v")))
    assert [r[0] for r in got] == [None, None, None, None, "a", None]


@pytest.mark.parametrize(
    "text, value",
    [("4.6", 5), ("4.5", 5), ("-4.5", -5), (".5", 1), ("1e2", 100), ("32767.4", 32767), ("32767.5", None), ("40000", None),
     (" 7 ", 7), ("007", 7), ("+3", 3), ("", None), ("/N", None), ("abc", None), ("1 2", None), (None, None)],
)
def test_to_int(spark, text, value):
    assert one(spark, [text], "string", clean.to_int(F.col("v"), "smallint")) == [(value,)]


@pytest.mark.parametrize(
    "text, ok",
    [("2018-01-05", True), ("2018/01/05", True), ("2018 01 05", True), ("2018-1-5", True), ("2018-01-05T10:00:00", True),
     (" 2018-01-05 ", True), ("2018", False), ("2018-01", False), ("2018-01/05", False), ("2018-13-05", False),
     ("2018-01-05 abc", False), ("/N", False), (None, False)],
)
def test_to_date(spark, text, ok):
    assert one(spark, [text], "string", clean.to_date(F.col("v"))) == [(dt.date(2018, 1, 5) if ok else None,)]


def test_week_of(spark):
    got = one(spark, ["201805", "5", "/N", "201853", "ab"], "string", clean.week_of(F.col("v")))
    assert [r[0] for r in got] == [5, 5, None, 53, None]


def test_labels_match_untrimmed(spark):
    assert one(spark, ["M", " M", None, "X"], "string", clean.label("sexo", F.col("v"))) == [
        ("Masculino",), ("Ignorado",), ("Ignorado",), ("Ignorado",)]
    assert one(spark, ["7", "1"], "string", clean.label("criterio_confirmacao", F.col("v"))) == [(None,), ("Laboratorial",)]
    assert one(spark, ["9", None], "string", clean.label("classificacao_final", F.col("v"))) == [("Em investigação",)] * 2


def test_is_marked(spark):
    got = one(spark, [None, "0", "/N", "", " 0 ", "1", "x"], "string", clean.is_marked(F.col("v")))
    assert [r[0] for r in got] == [False] * 5 + [True] * 2


CODES = [4025, 3006, 2010, 1219, 5001, None, 4, 425, 14025, -4025, 4000]


def test_age_decimal_and_sql_agree(spark):
    age.register_age_function(spark)
    got = one(spark, CODES, "smallint", age.age_years(F.col("v")), F.expr("idade_anos(v)"))
    want = [Decimal("25.00"), Decimal("0.50"), Decimal("0.03"), Decimal("0.03"), None, None, None, Decimal("25.00"), None, None,
            Decimal("0.00")]
    assert [r[0] for r in got] == want
    assert [r[1] for r in got] == want


def test_age_double_reads_all_digits(spark):
    got = one(spark, [4025, 14025, 4, None], "smallint", age.age_years_double(F.col("v")))
    assert [r[0] for r in got] == [25.0, 0.46, None, None]


def test_age_bands(spark):
    got = one(spark, [4.99, 5.0, 79.99, 80.0, None], "double", age.age_band(F.col("v")), age.age_band(F.col("v"), None))
    assert [r[0] for r in got] == ["0-4", "5-9", "70-79", "80+", "80+"]
    assert got[-1][1] is None
    ranks = one(spark, ["0-4", "80+"], "string", age.band_rank(F.col("v")))
    assert [r[0] for r in ranks] == [1, 11]


def test_weeks_and_years(spark):
    day = dt.date(2021, 1, 3)
    assert one(spark, [day], "date", calendar.week_start(F.col("v")), calendar.iso_week(F.col("v"))) == [(dt.date(2020, 12, 28), 53)]
    days = [dt.date(2019, 12, 31), dt.date(2020, 1, 1), dt.date(2021, 12, 31), dt.date(2022, 1, 1)]
    assert [r[0] for r in one(spark, days, "date", calendar.in_years(F.col("v"), 2020, 2021))] == [False, True, True, False]


def test_ratios_guard_zero(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(stats.percent(F.col("a"), F.col("b"))).collect()] == [25.0, 0.0, 0.0]


def t_density(t, n):
    return math.gamma((n + 1) / 2) / (math.sqrt(n * math.pi) * math.gamma(n / 2)) * (1 + t * t / n) ** (-(n + 1) / 2)


@pytest.mark.parametrize("t", [0.3, 2.5])
def test_t_distribution(spark, t):
    got = one(spark, list(range(1, 13)), "int", stats.t_two_sided_p(F.lit(t), F.col("v")))
    for n, (p,) in enumerate(got, 1):
        x = np.linspace(0, t, 20001)
        y = np.array([t_density(v, n) for v in x])
        inside = float(((y[1:] + y[:-1]) / 2 * np.diff(x)).sum())
        assert p == pytest.approx(1 - 2 * inside, abs=1e-7)
