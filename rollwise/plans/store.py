"""A store of order-level sums, so that a daily run reads new days instead of twelve years of positions.

The store is a table partitioned by the month of the reporting date. It holds one row per account,
order, order day and reporting day, with the lifetime measures of those positions; order keys stay,
because an order that is reported in parts counts once. A day that is new or corrected is brought in by
the date-range refresh: its month is read from the positions and replaced, nothing else is touched.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwise.functions import in_days
from rollwise.params import Params
from rollwise.plans.population import ACCOUNT
from rollwise.plans.positions import LIFETIME_MEASURES, lifetime_kpis_of, per_order
from rollwise.sources.sinks import refresh_partitions

MONTH = "reporting_month"
DAYS = ("order_day", "reporting_day")


def lifetime_partials(positions: DataFrame) -> DataFrame:
    """Rows of the store for ``positions``."""
    rows = positions.withColumns({"order_day": F.to_date("orderdate"), "reporting_day": F.to_date("reportingdate")})
    partials = per_order(rows, [*ACCOUNT, *DAYS], LIFETIME_MEASURES)
    return partials.withColumn(MONTH, F.trunc("reporting_day", "month"))


def _whole_months(lo: date, hi: date) -> tuple[date, date]:
    return lo.replace(day=1), (hi.replace(day=1) + timedelta(days=32)).replace(day=1) - timedelta(days=1)


def create_store(positions: DataFrame, table: str, path: str | None = None) -> None:
    """Create the store from all ``positions``; those without a reporting date never count."""
    dealt = lifetime_partials(positions.filter("reportingdate IS NOT NULL")).hint("rebalance", MONTH)
    writer = dealt.write.format("parquet").partitionBy(MONTH)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def refresh_store(positions: DataFrame, table: str, lo: date, hi: date) -> None:
    """Bring the reporting days [lo, hi] of ``positions`` into the store; reads their months only."""
    first, last = _whole_months(lo, hi)
    partials = lifetime_partials(positions.filter(in_days(positions, "reportingdate", first, last)))
    refresh_partitions(partials, table, MONTH, first, last)


def lifetime_kpis_from(store: DataFrame, params: Params) -> DataFrame:
    """``lifetime_kpis`` as of any day, from the store alone."""
    start, end = params.lifetime_start, params.as_of
    months = in_days(store, MONTH, *_whole_months(start, end))
    rows = store.filter(months & in_days(store, "reporting_day", start, end) & in_days(store, "order_day", start, end))
    return lifetime_kpis_of(rows.withColumn("counted", F.lit(True)))
