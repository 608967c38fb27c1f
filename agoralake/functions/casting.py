"""Lenient casts from exported text: a bad value becomes NULL (or a default), never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# How a missing cell is spelled in exported files.
MISSING_WORDS = ["nan", "None"]

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_DATE_HEAD = r"^\d{4}-\d{2}-\d{2}([T ].*)?$"


def text_or(c: Column, default: str = "") -> Column:
    """Missing cell -> default; anything else unchanged."""
    return F.when(c.isNull() | c.isin(MISSING_WORDS), F.lit(default)).otherwise(c)


def text_or_null(c: Column) -> Column:
    """Missing or empty cell -> NULL."""
    return F.when(c.isNull() | c.isin(MISSING_WORDS) | (c == ""), F.lit(None)).otherwise(c)


def blank_to_null(c: Column) -> Column:
    """Missing, empty or all-space cell -> NULL; the value itself is not trimmed."""
    return F.when(c.isNull() | F.trim(c).isin(MISSING_WORDS + [""]), F.lit(None)).otherwise(c)


def lenient_double(c: Column, default: float | None = None) -> Column:
    value = F.when(c.rlike(_NUMBER), c.try_cast("double"))
    return value if default is None else F.coalesce(value, F.lit(default))


def lenient_int(c: Column, default: int | None = None) -> Column:
    """Integer by way of double, cut towards zero (``12.7`` -> 12)."""
    value = lenient_double(c).try_cast("bigint")
    return value if default is None else F.coalesce(value, F.lit(default).cast("bigint"))


def lenient_timestamp(c: Column) -> Column:
    """ISO, ``Z``-suffixed or space-separated text -> timestamp; text without a zone is read in the session zone (UTC)."""
    return F.when(F.trim(c).rlike(_DATE_HEAD), F.trim(c).try_cast("timestamp"))


def plain_timestamp_text(c: Column) -> Column:
    """``2024-01-02T03:04:05Z`` -> ``2024-01-02 03:04:05``."""
    return F.replace(F.replace(c, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(""))


def first_ten_as_date(c: Column) -> Column:
    return F.substring(c, 1, 10).try_cast("date")


def finite_or_null(c: Column) -> Column:
    """NaN and infinities -> NULL."""
    infinite = F.abs(c) == F.lit(float("inf"))
    return F.when(F.isnan(c) | infinite, F.lit(None)).otherwise(c)


def finite_map(m: Column) -> Column:
    return F.transform_values(m, lambda _, v: finite_or_null(v))


def coerce_columns(df: DataFrame, int_columns: list[str]) -> DataFrame:
    """Every empty cell -> NULL; the listed columns -> integer."""
    ints = set(int_columns)
    return df.select([
        (lenient_int(F.col(c)) if c in ints else F.nullif(F.col(c), F.lit(""))).alias(c) for c in df.columns
    ])
