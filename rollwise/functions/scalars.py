"""Scalar semantics shared by all plans, as built-in expressions only."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def day_literal(day: date) -> str:
    return f"DATE'{day.isoformat()}'"


def round_to_long(value: Column) -> Column:
    """Whole number nearest to ``value``, halves away from zero (a plain cast would truncate)."""
    return F.round(value).cast("long")


def round_to_long_sql(expr: str) -> str:
    return f"CAST(round({expr}) AS BIGINT)"


def upper_sql(text: str, letters: str) -> str:
    """``upper(text)`` as far as tests for the capital ASCII ``letters`` can tell.

    Plain ASCII texts only have these letters exchanged, which is much cheaper than Unicode's rules; those
    are kept for all other texts, where a capital may come from a ligature or a letter without a dot.
    """
    plain = f"octet_length({text}) = char_length({text})"
    return f"CASE WHEN {plain} THEN translate({text}, '{letters.lower()}', '{letters}') ELSE upper({text}) END"


def ratio_sql(part: str, whole: str) -> str:
    """``part / whole`` as double, NULL unless ``whole`` is positive."""
    return f"CASE WHEN {whole} > 0 THEN {part} / {whole} END"


def in_days_sql(column: str, lo: date, hi: date) -> str:
    """Day of ``column``, a date or a timestamp, within the closed range, for expressions above the scan.

    Beside a timestamp, Spark reads a date literal as its midnight, once; the column stays bare, since
    taking the day of each timestamp passes through calendar objects.
    """
    return f"({column} >= {day_literal(lo)} AND {column} < {day_literal(hi + timedelta(days=1))})"


def _bound(dtype: T.DataType, day: date) -> Column:
    name = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
    return F.lit(f"{day.isoformat()} 00:00:00").cast(name)


def in_days(df: DataFrame, column: str, lo: date | None = None, hi: date | None = None) -> Column:
    """Filter form of "the day of ``column`` lies in [lo, hi]", open where a bound is None.

    Timestamps are compared with midnight bounds instead of being cast to a date, so that the
    predicate stays on the bare column and reaches the Parquet scan; the last day is included
    up to midnight.
    """
    dtype = df.schema[column].dataType
    cond = F.lit(True)
    if isinstance(dtype, T.DateType):
        if lo is not None:
            cond = F.col(column) >= F.lit(lo)
        if hi is not None:
            upper = F.col(column) <= F.lit(hi)
            cond = upper if lo is None else cond & upper
        return cond
    if lo is not None:
        cond = F.col(column) >= _bound(dtype, lo)
    if hi is not None:
        upper = F.col(column) < _bound(dtype, hi + timedelta(days=1))
        cond = upper if lo is None else cond & upper
    return cond


def valid_at(df: DataFrame, valid_from: str, valid_to: str, day: date, closed: bool = False) -> Column:
    """History row in force on ``day``: from <= day < to, or day <= to when ``closed``."""
    started = in_days(df, valid_from, hi=day)
    ends_after = in_days(df, valid_to, lo=day if closed else day + timedelta(days=1))
    return started & ends_after
