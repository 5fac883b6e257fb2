"""Readers for the raw case file and the municipality gazetteer."""

from __future__ import annotations

import csv
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from epiframe.contracts import CASE_COLUMNS, UF_SIGLAS
from epiframe.operators.ids import arrival_id


def header_of(spark: SparkSession, path: str, skip: int = 0) -> list[str]:
    """Column names in the header line, which is line ``skip`` of the file.

    Reads the first lines only.
    """
    line = spark.read.text(path).take(skip + 1)[skip][0]
    return [name.strip() for name in next(csv.reader([line.lstrip("\ufeff")]))]


def read_case_file(
    spark: SparkSession, path: str | list[str], with_id: bool = True, multi_line: bool = False, **options: str
) -> DataFrame:
    """All columns as text, only the mapped ones kept under their domain names.

    ``row_id`` numbers the records from 1 in file order. A record with too few or too many fields
    stops the load, and so does a quoted line break unless ``multi_line`` is set; a file is then
    one task's work, as its records can't be told apart from within.
    """
    settings = {"header": True, "inferSchema": False, "enforceSchema": False, "mode": "FAILFAST", "multiLine": multi_line}
    # With columns pruned, the parser would not see that a record is too short.
    raw = spark.read.options(**{**settings, "columnPruning": False, **options}).csv(path)
    cases = arrival_id(raw) if with_id else raw
    kept = ["row_id"] if with_id else []
    return cases.select(*kept, *[F.col(f"`{old}`").alias(new) for old, new in CASE_COLUMNS.items()])


def find_column(names: list[str], wanted: Callable[[str], bool]) -> str:
    """First header name that satisfies ``wanted``."""
    for name in names:
        if wanted(name):
            return name
    raise LookupError(f"no matching column among {names}")


def gazetteer_columns(names: list[str]) -> dict[str, str]:
    """Domain name -> header name, tolerant of small changes in the header."""
    return {
        "uf_code": find_column(names, lambda n: n == "UF"),
        "uf_nome": find_column(names, lambda n: n == "Nome_UF"),
        "municipio_id": find_column(names, lambda n: "digo" in n and "Munic" in n),
        "municipio_nome": find_column(names, lambda n: n.startswith("Nome") and "Munic" in n),
    }


def read_gazetteer(spark: SparkSession, path: str, skip: int = 6) -> DataFrame:
    """Municipality table exported as CSV with ``skip`` title lines above the header."""
    names = header_of(spark, path, skip)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = spark.read.schema(schema).csv(path)
    picked = gazetteer_columns(names)
    # Title lines and the header have no numeric municipality code.
    body = rows.filter(F.trim(F.col(f"`{picked['municipio_id']}`")).rlike("^[0-9]+$"))
    return body.select(*[F.col(f"`{old}`").alias(new) for new, old in picked.items()])


def uf_siglas(spark: SparkSession) -> DataFrame:
    """The fixed 27-row code table."""
    return spark.createDataFrame(list(UF_SIGLAS.items()), "uf_id smallint, sigla string")
