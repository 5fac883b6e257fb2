"""Column expressions that turn raw text into typed values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from epiframe.contracts import LABEL_DEFAULTS, LABELS

NULL_MARK = "/N"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_DATE = r"^\d{4}([-/ ])\d{1,2}\1\d{1,2}([ T]\d{1,2}:\d{2}:\d{2}(\.\d+)?)?$"
_DATE_PART = r"^(\d{4}[-/ ]\d{1,2}[-/ ]\d{1,2})"


def nullify(c: Column) -> Column:
    """Trimmed text, with the empty string and the null mark as NULL."""
    return F.when(~F.trim(c).isin("", NULL_MARK), F.trim(c))


def not_sentinel(c: Column, *extra: str) -> Column:
    """True where the text is present and, trimmed, none of the null marks or ``extra``."""
    return c.isNotNull() & ~F.trim(c).isin("", NULL_MARK, *extra)


def to_int(c: Column, type_name: str) -> Column:
    """Lenient integer parse: rounds decimals and exponents, NULL when malformed or too big.

    Plain digits take the cheap cast; only the rest pays for the pattern. Blank text and the
    null mark are malformed, so they need no ``nullify`` first.
    """
    decimal = F.round(c.try_cast("double")).try_cast(type_name)
    return F.coalesce(c.try_cast(type_name), F.when(F.trim(c).rlike(_NUMBER), decimal))


def to_date(c: Column) -> Column:
    """Lenient date parse: ``-``, ``/`` or blank between the parts, optional time of day.

    Blank text and the null mark give NULL.
    """
    text = F.trim(c)
    part = F.regexp_replace(F.regexp_extract(text, _DATE_PART, 1), "[/ ]", "-")
    iso = text.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return F.when(iso, text.try_cast("date")).when(text.rlike(_DATE), part.try_cast("date"))


def week_of(c: Column) -> Column:
    """Week number from a ``YYYYWW`` code."""
    return to_int(F.right(F.trim(c), F.lit(2)), "smallint")


def label(field: str, c: Column | None = None) -> Column:
    """Label of a coded answer; the code must match exactly, blanks included.

    A literal map keeps the generated code small when many labels are made in one projection.
    """
    source = F.col(field) if c is None else c
    labels = F.create_map(*[F.lit(x) for pair in LABELS[field].items() for x in pair])
    found = F.try_element_at(labels, source)
    default = LABEL_DEFAULTS.get(field)
    return found if default is None else F.coalesce(found, F.lit(default))


def is_marked(c: Column) -> Column:
    """True for anything but NULL, blank, ``0`` and the null mark."""
    return F.coalesce(~F.trim(c).isin("", "0", NULL_MARK), F.lit(False))


def prefix6(c: Column) -> Column:
    """Six-character municipality prefix used by the case file."""
    return F.substring(c, 1, 6)
