"""Profitable-order rates and order profit."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwise.functions import in_days, in_days_sql
from rollwise.operators.periods import period_sums
from rollwise.params import Params, Period
from rollwise.plans.population import ACCOUNT

# Single half years that reach the output of the order rates, and those of the profit sums.
RATED_PERIODS = 5
PROFIT_PERIODS = 6


def rated_periods(params: Params) -> tuple[Period, ...]:
    return (*params.periods[:RATED_PERIODS], *params.composite_periods())


def order_counts(order_profit: DataFrame, params: Params, periods: tuple[Period, ...]) -> DataFrame:
    """Distinct orders, and distinct orders with a profit, per partner and period.

    Periods may overlap and one order may be reported in several of them. Each order is first
    reduced to one flag per period, so a count is a sum of flags and an order counts once in a
    composite period. Orders without profit or loss are left out; there is no upper date bound,
    so a partner with later orders only is present with zeros.
    """
    oldest = params.periods[-1].lo + timedelta(days=1)
    rows = order_profit.filter(
        (F.col("firmid") == params.firm_id)
        & in_days(order_profit, "reportingdate", lo=oldest)
        & (F.col("orderprofit_crm") != 0)
    )
    tests = {}
    for p in periods:
        inside = in_days_sql("reportingdate", p.lo, p.hi)
        tests[f"Orders_{p.name}"] = inside
        tests[f"OrdersWithProfit_{p.name}"] = f"{inside} AND orderprofit_crm > 0"
    per_order = rows.groupBy("bpid", "orderid").agg(
        *[F.expr(f"max(CASE WHEN {test} THEN 1 ELSE 0 END) AS {name}") for name, test in tests.items()]
    )
    return per_order.groupBy("bpid").agg(
        *[F.expr(f"sum(CASE WHEN orderid IS NOT NULL THEN {name} ELSE 0 END) AS {name}") for name in tests]
    )


def order_quotes(accounts: DataFrame, order_profit: DataFrame, params: Params) -> DataFrame:
    """Orders, orders with profit and their rate per period, for accounts with any such order."""
    periods = rated_periods(params)
    counts = order_counts(order_profit, params, periods)
    columns = []
    for p in periods:
        orders, profitable = f"Orders_{p.name}", f"OrdersWithProfit_{p.name}"
        rate = f"round(CASE WHEN {orders} > 0 THEN {profitable} / {orders} ELSE 0D END, 3)"
        columns += [orders, profitable, f"{rate} AS PositiveOrderRate_{p.name}"]
    return accounts.select(*ACCOUNT).distinct().join(counts, "bpid").selectExpr(*ACCOUNT, *columns)


def profit_by_period(order_profit: DataFrame, params: Params) -> DataFrame:
    """Order profit per partner and half year; a partner with later orders only is present with NULLs."""
    periods = params.periods[:PROFIT_PERIODS]
    rows = order_profit.filter(
        (F.col("firmid") == params.firm_id) & in_days(order_profit, "reportingdate", lo=periods[-1].lo)
    )
    return rows.groupBy("bpid").agg(*period_sums("reportingdate", periods, {"orderprofit_": "orderprofit_crm"}))
