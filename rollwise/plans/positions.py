"""Order position measures per account and half year, and lifetime values.

One pass over the positions serves all half years. It aggregates twice: first per order, where an
order becomes a set of 0/1 flags, then per account and half year, where summing the flags counts
distinct orders. That needs no row-multiplying Expand, and both levels combine before they
shuffle, so an account holding a large part of all positions reaches the second shuffle as a few
rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwise.functions import (
    big_size_sql,
    day_literal,
    in_category_sql,
    in_days,
    ratio_sql,
    round_to_long_sql,
    upper_sql,
)
from rollwise.functions.categories import CATEGORIES, MATERNITY_PREFIX
from rollwise.operators.periods import assign_period, period_columns, period_or_null
from rollwise.params import Params
from rollwise.plans.population import ACCOUNT, demand_prepared, demand_slots, is_recent_demand

# Record types of a position.
DEMAND, CANCEL, GROSS, RETURN, NET, VOUCHER = 1, 3, 5, 6, 91, 701
# Catalogue types of the online shop; order channel letters.
ONLINE_CATALOGUES = (20, 60)
PHONE, INTERNET, MAIL = "T", "I", "S"


@dataclass(frozen=True)
class Measure:
    """``value`` summed, orders counted, or a flag raised, over the rows that satisfy ``when``.

    ``kind`` is "sum", "cents", "orders" or "any". All texts are SQL over the prepared position columns.
    "cents" is the sum of a decimal value: hundredths are summed as whole numbers, which need no object
    per row, up to the account, where they become a decimal again.
    """

    name: str
    kind: str
    when: str
    value: str = "1"

    def per_order(self) -> str:
        if self.kind == "sum":
            return f"sum(CASE WHEN {self.when} THEN {self.value} END)"
        if self.kind == "cents":
            return f"sum(CASE WHEN {self.when} THEN CAST({self.value} * 100 AS BIGINT) END)"
        return f"max(CASE WHEN {self.when} THEN 1 ELSE 0 END)"

    def per_account(self) -> str:
        if self.kind == "sum":
            return f"sum({self.name})"
        if self.kind == "cents":
            return f"CAST(sum({self.name}) * 0.01BD AS DECIMAL(38,2))"
        if self.kind == "orders":
            return f"sum(CASE WHEN orderid IS NOT NULL THEN {self.name} ELSE 0 END)"
        return f"max({self.name})"


# Columns prepared once per position, so that no measure repeats a rounding. Long tests that few measures
# need stay in their aggregates, each of which Spark gives a method of its own: Java compiles no method of
# more than 8,000 bytes, and the one that prepares a position would become that long.
UNITS, VALUE = "units", "value"
# What only demand is asked for is worked out for demand only.
PREPARED = {
    "prefix": f"CASE WHEN rectype = {DEMAND} THEN substring(promotionpurchasecd, 1, 2) END",
    UNITS: round_to_long_sql("kpivalueqty"),
    VALUE: round_to_long_sql("kpivaluevk"),
    "online": f"catalogtypeid IN {ONLINE_CATALOGUES}",
    "channel": f"CASE WHEN rectype = {DEMAND} THEN {upper_sql('orderchannelcd', PHONE + INTERNET + MAIL)} END",
}


def _rectype(code: int, extra: str = "") -> str:
    return f"rectype = {code}" + (f" AND {extra}" if extra else "")


# A position without catalogue type is neither.
_ONLINE = "online"
_CATALOGUE = "NOT online"

# Categories whose quantities are summed as they are; all others are rounded row by row.
_UNROUNDED = ("Bade", "Sport", "Acc")

MEASURES = (
    Measure("Nabs_ges", "sum", _rectype(NET), UNITS),
    Measure("Nums_ges", "sum", _rectype(NET), VALUE),
    Measure("StornoMenge_ges", "sum", _rectype(CANCEL), UNITS),
    Measure("StornoWert_ges", "sum", _rectype(CANCEL), VALUE),
    Measure("Nabs_online", "sum", _rectype(NET, _ONLINE), UNITS),
    Measure("Nums_online", "sum", _rectype(NET, _ONLINE), VALUE),
    Measure("Nabs_katbez", "sum", _rectype(NET, _CATALOGUE), UNITS),
    Measure("Nums_katbez", "sum", _rectype(NET, _CATALOGUE), VALUE),
    Measure("Orders_katbez", "orders", _rectype(DEMAND, _CATALOGUE)),
    Measure("telbweg", "any", _rectype(DEMAND, f"contains(channel, '{PHONE}')")),
    Measure("brabs_ges", "sum", _rectype(GROSS), UNITS),
    Measure("brums_ges", "sum", _rectype(GROSS), VALUE),
    Measure("Retwert", "sum", _rectype(RETURN), VALUE),
    Measure("RetMenge", "sum", _rectype(RETURN), UNITS),
    Measure("NF_ges", "sum", _rectype(DEMAND), VALUE),
    Measure("NFMenge_ges", "sum", _rectype(DEMAND), UNITS),
    Measure("Orders_ges", "orders", _rectype(DEMAND)),
    Measure("Orders_OLSArt", "orders", _rectype(DEMAND, _ONLINE)),
    Measure("onlbweg", "any", _rectype(DEMAND, f"contains(channel, '{INTERNET}')")),
    *[
        Measure(
            f"{name}BM_ges",
            "cents" if name in _UNROUNDED else "sum",
            _rectype(DEMAND, in_category_sql("prefix", name)),
            "kpivalueqty" if name in _UNROUNDED else UNITS,
        )
        for name in CATEGORIES
    ],
    Measure("RiesigBM_ges", "sum", _rectype(DEMAND, big_size_sql("prefix", "promotionpurchasecd", "itemsize")), UNITS),
    Measure("Nutzung_VKB", "orders", _rectype(VOUCHER)),
    Measure("Umstand_BM", "sum", _rectype(DEMAND, f"prefix = '{MATERNITY_PREFIX}'"), UNITS),
)
MEASURE_NAMES = tuple(m.name for m in MEASURES)

LIFETIME_MEASURES = (
    Measure("LifeTimeOrders", "orders", _rectype(DEMAND)),
    Measure("LifetimeGrossSalesAmt", "sum", _rectype(GROSS), VALUE),
    Measure("LifetimeGrossSalesQty", "sum", _rectype(GROSS), UNITS),
    # The two return names are crossed in the model: Amt holds units and Qty holds value.
    Measure("LifetimeReturnAmt", "sum", _rectype(RETURN), UNITS),
    Measure("LifetimeReturnQty", "sum", _rectype(RETURN), VALUE),
    Measure("LifetimeNetSalesAmt", "sum", _rectype(NET), VALUE),
    Measure("LifetimeNetSalesQty", "sum", _rectype(NET), UNITS),
    Measure("LifetimeOrdersOnline", "orders", _rectype(DEMAND, f"channel = '{INTERNET}'")),
    Measure("LifetimeOrdersOffline", "orders", _rectype(DEMAND, f"channel IN ('{PHONE}', '{MAIL}')")),
)
LIFETIME_NAMES = tuple(m.name for m in LIFETIME_MEASURES)
# Lifetime measures that are the same, per order, as one of a half year.
LIFETIME_TWINS = {
    whole.name: m.name
    for whole in LIFETIME_MEASURES
    for m in MEASURES
    if (whole.kind, whole.when, whole.value) == (m.kind, m.when, m.value)
}


def per_order(rows: DataFrame, keys: Sequence[str], measures: Sequence[Measure], others: dict[str, str] | None = None) -> DataFrame:
    """Measures per order and ``keys``: sums, and flags for what is counted."""
    prepared = rows.withColumns({name: F.expr(sql) for name, sql in PREPARED.items()})
    aggregates = {m.name: m.per_order() for m in measures} | (others or {})
    return prepared.groupBy(*keys, "orderid").agg(*[F.expr(f"{sql} AS {name}") for name, sql in aggregates.items()])


def _per_account(per_order: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    return per_order.groupBy(*keys).agg(*[F.expr(f"{m.per_account()} AS {m.name}") for m in measures])


def _two_levels(rows: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    return _per_account(per_order(rows, keys, measures), keys, measures)


def period_positions(positions: DataFrame, params: Params) -> DataFrame:
    """Positions placed in the half year of their order date, if reported within its grace range."""
    return assign_period(positions, "orderdate", params.periods, reporting="reportingdate")


def position_kpis_long(
    positions: DataFrame, params: Params, names: Sequence[str] = MEASURE_NAMES
) -> DataFrame:
    """The measures ``names``, one row per account and half year with positions."""
    return _two_levels(
        period_positions(positions, params), [*ACCOUNT, "period"], [m for m in MEASURES if m.name in names]
    )


def position_kpis_wide(
    positions: DataFrame, params: Params, names: Sequence[str] = MEASURE_NAMES
) -> DataFrame:
    """The measures ``names`` as columns ``<measure>_S<k>``, one row per account."""
    return period_columns(position_kpis_long(positions, params, names), ACCOUNT, params.periods, names)


def in_lifetime(positions: DataFrame, params: Params) -> Column:
    """Filter form: ordered and reported since the lifetime start, which is before the oldest half year."""
    days = (params.lifetime_start, params.as_of)
    return in_days(positions, "reportingdate", *days) & in_days(positions, "orderdate", *days)


def lifetime_kpis(positions: DataFrame, params: Params) -> DataFrame:
    """Lifetime totals of positions ordered and reported since the lifetime start."""
    return _two_levels(positions.filter(in_lifetime(positions, params)), ACCOUNT, LIFETIME_MEASURES)


def order_facts(positions: DataFrame, params: Params, names: Sequence[str] = MEASURE_NAMES) -> DataFrame:
    """All that a run needs of the positions, per account, order and half year, in one pass.

    Positions are placed in two calendars at once. Half-year measures follow the order date: the half
    year is NULL for positions that count for the lifetime only, those ordered before the oldest half
    year and those reported after the grace range of theirs. Demand follows the reporting date and has
    a column per half year. ``counted`` tells which rows are of the lifetime; the others hold demand of
    orders from before it. Every column costs each position and each order, so there are only the
    half-year measures ``names``, those the lifetime shares with them, and what the lifetime has alone.
    """
    lifetime = F.coalesce(in_lifetime(positions, params), F.lit(False))
    rows = positions.filter(lifetime | is_recent_demand(positions, params)).withColumn("counted", lifetime)
    rows = rows.withColumn("period", F.when(F.col("counted"), period_or_null("orderdate", params.periods, "reportingdate")))
    rows = rows.withColumns({name: F.expr(sql) for name, sql in demand_prepared(params).items()})
    needed = {*names, *LIFETIME_TWINS.values()}
    measures = [m for m in MEASURES if m.name in needed] + [m for m in LIFETIME_MEASURES if m.name not in LIFETIME_TWINS]
    return per_order(rows, [*ACCOUNT, "period", "counted"], measures, demand_slots(params))


def period_kpis_of(orders: DataFrame) -> DataFrame:
    """``position_kpis_long`` from ``order_facts``, of the measures these have."""
    measures = [m for m in MEASURES if m.name in orders.columns]
    return _per_account(orders.filter("period IS NOT NULL"), [*ACCOUNT, "period"], measures)


def lifetime_kpis_of(orders: DataFrame) -> DataFrame:
    """``lifetime_kpis`` from ``order_facts``; an order counts once whatever its half years."""
    shared = {name: F.col(twin) for name, twin in LIFETIME_TWINS.items() if name not in orders.columns}
    whole = orders.filter("counted").withColumns(shared).groupBy(*ACCOUNT, "orderid").agg(
        *[F.expr(f"{'sum' if m.kind == 'sum' else 'max'}({m.name}) AS {m.name}") for m in LIFETIME_MEASURES]
    )
    return _per_account(whole, ACCOUNT, LIFETIME_MEASURES)


# NULL as soon as returns or net sales are missing; 1 is reached with net sales of zero.
RATES = {
    "RSQ": ratio_sql("RetMenge", "(RetMenge + Nabs_ges)"),
    "RWQ": ratio_sql("Retwert", "(Retwert + Nums_ges)"),
}


def with_rates(long: DataFrame) -> DataFrame:
    """Add the return rates by quantity and by value."""
    return long.withColumns({name: F.expr(sql) for name, sql in RATES.items()})


def with_breadth(long: DataFrame) -> DataFrame:
    """Add the number of categories bought, 0 to 9, as ``AnzSorti``."""
    bought = " + ".join(f"CASE WHEN {name}BM_ges > 0 THEN 1 ELSE 0 END" for name in CATEGORIES)
    return long.withColumn("AnzSorti", F.expr(bought))


# Weight of each half year in the activity masks, newest first.
ACTIVITY_WEIGHTS = (32, 16, 8, 4, 2)
ACTIVITY_MASKS = {"AktivKennzeichen": "Nums_ges", "AktivOLKennzeichen": "Nums_online"}


def with_activity(long: DataFrame) -> DataFrame:
    """Add the weight of the half year to each mask for which its (online) net sales are positive."""
    weights = " ".join(f"WHEN 'S{k}' THEN {weight}" for k, weight in enumerate(ACTIVITY_WEIGHTS, start=1))
    weight = f"CASE period {weights} ELSE 0 END"
    return long.withColumns(
        {name: F.expr(f"CASE WHEN {measure} > 0 THEN {weight} ELSE 0 END") for name, measure in ACTIVITY_MASKS.items()}
    )


def activity_mask_sql(name: str) -> str:
    """A mask from its weights per half year; missing half years add nothing."""
    return " + ".join(f"coalesce({name}_S{k}, 0)" for k in range(1, len(ACTIVITY_WEIGHTS) + 1))


def masked_sql(column: str, params: Params, k: int) -> str:
    """``column`` of half year k, NULL for accounts not older than the end of that half year."""
    return f"CASE WHEN accountDate >= {day_literal(params.period(k).hi)} THEN NULL ELSE {column} END"


def mask_long(long: DataFrame, params: Params, names: Sequence[str]) -> DataFrame:
    """``masked_sql`` applied to the measures ``names`` while each half year is still a row."""
    ends = " ".join(f"WHEN '{p.name}' THEN {day_literal(p.hi)}" for p in params.periods)
    too_new = f"accountDate >= CASE period {ends} END"
    others = [name for name in long.columns if name not in names]
    return long.selectExpr(*others, *[f"CASE WHEN {too_new} THEN NULL ELSE {name} END AS {name}" for name in names])
