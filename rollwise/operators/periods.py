"""Placing facts in periods and turning one row per period into columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwise.functions.scalars import day_literal, in_days, in_days_sql
from rollwise.params import Period


def covering_range(df: DataFrame, column: str, periods: Iterable[Period]) -> Column:
    """Outer bounds of ``periods`` as a filter the scan can use; Catalyst cannot derive it from a CASE."""
    periods = list(periods)
    return in_days(df, column, min(p.lo for p in periods), max(p.hi for p in periods))


def _adjacent(periods: Sequence[Period]) -> bool:
    return all(newer.lo - older.hi == timedelta(days=1) for newer, older in zip(periods, periods[1:]))


def _by_period_sql(column: str, periods: Sequence[Period], results: Sequence[str]) -> str:
    """The result of the disjoint period the day of ``column`` falls in.

    Within the outer bounds of adjacent periods, newest first, the first day of each is enough.
    """
    tests = [in_days_sql(column, p.lo, p.hi) for p in periods]
    if _adjacent(periods):
        tests = [f"{column} >= {day_literal(p.lo)}" for p in periods]
    return "CASE " + " ".join(f"WHEN {test} THEN {result}" for test, result in zip(tests, results)) + " END"


def assign_period(df: DataFrame, column: str, periods: Sequence[Period], reporting: str | None = None) -> DataFrame:
    """Keep the rows whose ``column`` lies in one of the disjoint ``periods``; add its name as ``period``.

    With ``reporting``, that second date must lie in the reporting range of the same period. The
    periods are literals of the plan: no join and no shuffle, whatever their number.
    """
    placed = df.filter(covering_range(df, column, periods))
    if reporting is not None:
        last = max(p.last_reporting_day for p in periods)
        placed = placed.filter(in_days(df, reporting, min(p.lo for p in periods), last))
        ranges = [in_days_sql(reporting, p.lo, p.last_reporting_day) for p in periods]
        placed = placed.filter(F.expr(_by_period_sql(column, periods, ranges)))
    placed = placed.withColumn("period", F.expr(_by_period_sql(column, periods, [f"'{p.name}'" for p in periods])))
    return placed if _adjacent(periods) else placed.filter(F.col("period").isNotNull())


def period_or_null(column: str, periods: Sequence[Period], reporting: str) -> Column:
    """Name of the period of ``column`` if ``reporting`` lies in its reporting range, else NULL."""
    names = [f"CASE WHEN {in_days_sql(reporting, p.lo, p.last_reporting_day)} THEN '{p.name}' END" for p in periods]
    whole = f"{in_days_sql(column, min(p.lo for p in periods), max(p.hi for p in periods))}"
    return F.expr(f"CASE WHEN {whole} THEN {_by_period_sql(column, periods, names)} END")


def period_number_sql(column: str, periods: Sequence[Period]) -> str:
    """Position in ``periods`` of the disjoint period the day of ``column`` falls in, else NULL."""
    whole = in_days_sql(column, min(p.lo for p in periods), max(p.hi for p in periods))
    return f"CASE WHEN {whole} THEN {_by_period_sql(column, periods, [str(k) for k in range(len(periods))])} END"


def period_sums(column: str, periods: Iterable[Period], values: dict[str, str]) -> list[Column]:
    """One conditional sum per period and value, NULL when no row qualifies.

    ``values`` maps the column prefix to the summed SQL; the period name is appended to the prefix.
    """
    return [
        F.expr(f"sum(CASE WHEN {in_days_sql(column, p.lo, p.hi)} THEN {value} END) AS {prefix}{p.name}")
        for p in periods
        for prefix, value in values.items()
    ]


def period_columns(long: DataFrame, keys: Sequence[str], periods: Sequence[Period], values: Sequence[str]) -> DataFrame:
    """Turn one row per key and period into one row per key with a column ``<value>_<period>``.

    A period without a row gives NULL, a zero in an existing row stays 0. Each column is a slot of a
    hash aggregate over plain values. The rows are dealt by key first, as they are: combining before
    the exchange, as a pivot does, would send a row of all slots for every single period of a key. A key
    has one row per period at most, so none is large. Slots compare numbers, not the periods' names.
    """
    number = "CASE period " + " ".join(f"WHEN '{p.name}' THEN {k}" for k, p in enumerate(periods)) + " END"
    placed = long.select(*keys, F.expr(number).alias("slot"), *values).repartition(*keys)
    slots = [F.expr(f"max(CASE WHEN slot = {k} THEN {v} END) AS {v}_{p.name}") for k, p in enumerate(periods) for v in values]
    return placed.groupBy(*keys).agg(*slots)
