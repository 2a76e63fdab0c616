"""Who is in the output, and in which recency segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwise.functions import day_literal, in_days, round_to_long_sql, valid_at
from rollwise.operators.joins import absent_from
from rollwise.operators.periods import covering_range, period_number_sql, period_sums
from rollwise.params import Params
from rollwise.sources.tables import Sources

ACCOUNT = ("bpid", "accountDate")
DEMAND = 1
# Partner types of end customers; exclusion codes and their decision flag.
PARTNER_TYPES = ("Z001", "Z019")
EXCLUSION_CODES = (2, 4)
EXCLUDED = 1
# Recency segment by first half year with demand, newest first; the last entry is
# the segment without any demand. The detail splits segment 6 and is rolled up again in two.
SEGMENT_NEW = 2
SEGMENTS = (3, 4, 5, 6, 6, 6, 6, 6, 6)
SEGMENT_DETAILS = (None, None, None, 63, 64, 65, 66, 67, 68)
DETAIL_ROLLUP = {345: (63, 64, 65), 678: (66, 67, 68)}

POPULATION_COLUMNS = (
    "bpid",
    "accountDate",
    "Age",
    "YearsOfRelationship",
    "SalutationID",
    "TargetGroupIndexRoll",
    "TargetGroupIndexRollOld_org",
    "NK3",
)


def demand_rows(positions: DataFrame) -> DataFrame:
    return positions.filter(F.col("rectype") == DEMAND)


def demand_by_period(positions: DataFrame, params: Params) -> DataFrame:
    """Signed demand value per account and half year of the reporting date."""
    rows = demand_rows(positions)
    rows = rows.filter(covering_range(rows, "reportingdate", params.periods))
    return rows.groupBy(*ACCOUNT).agg(*period_sums("reportingdate", params.periods, {"bbw": "kpivaluevk"}))


def recent_demand(positions: DataFrame, params: Params) -> DataFrame:
    """Net demand since the inactivity horizon, of accounts at least that old."""
    rows = demand_rows(positions)
    since = params.inactive_since
    rows = rows.filter((F.col("accountDate") <= F.lit(since)) & in_days(rows, "reportingdate", lo=since))
    return rows.groupBy(*ACCOUNT).agg(F.sum("kpivaluevk").alias("nf"))


def inactive_accounts(src: Sources, params: Params) -> DataFrame:
    """Accounts older than the horizon whose demand since then is missing or nets to exactly zero."""
    return (
        src.customer_overview.filter(F.col("accountDate") <= F.lit(params.inactive_since))
        .join(recent_demand(src.positions, params), list(ACCOUNT), "left")
        .filter(F.coalesce(F.col("nf"), F.lit(0)) == 0)
        .select(*ACCOUNT)
    )


def excluded_partners(exclusion: DataFrame, params: Params) -> DataFrame:
    """Partners with an exclusion in force on the as-of day, once each."""
    in_force = (
        F.col("exclusioncd").isin(*EXCLUSION_CODES)
        & (F.col("decisionfg") == EXCLUDED)
        & valid_at(exclusion, "validfrom", "validto", params.as_of)
    )
    return exclusion.filter(in_force).select("bpid").distinct()


def eligible_customers(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("bptypeid").isin(*PARTNER_TYPES) & F.col("accountDate").isNotNull())


def age_and_tenure_sql(params: Params) -> dict[str, str]:
    return {
        "Age": round_to_long_sql(f"datediff({day_literal(params.anchor)}, birthdate) / 365"),
        "YearsOfRelationship": round_to_long_sql(f"datediff({day_literal(params.as_of)}, accountDate) / 365"),
    }


def _by_first_demand(values: tuple, params: Params) -> str:
    """Value for the first half year with demand; older half years need an account opened by S2."""
    s1, s2 = params.period(1), params.period(2)
    arms = []
    for k, value in enumerate(values, start=1):
        opened_by = s1.lo if k <= 2 else s2.lo
        has_demand = f" AND bbwS{k} > 0" if k <= len(params.periods) else ""
        then = "NULL" if value is None else value
        arms.append(f"WHEN accountDate <= {day_literal(opened_by)}{has_demand} THEN {then}")
    return " ".join(arms)


def segment_sql(params: Params) -> str:
    """Recency segment. Accounts opened between S2 and S1 without demand in either get NULL."""
    newest = day_literal(params.period(1).lo)
    return f"CASE WHEN accountDate > {newest} THEN {SEGMENT_NEW} {_by_first_demand(SEGMENTS, params)} END"


def segment_detail_sql(params: Params) -> str:
    newest = day_literal(params.period(1).lo)
    branches = _by_first_demand(SEGMENT_DETAILS, params)
    return f"CAST(CASE WHEN accountDate > {newest} THEN NULL {branches} END AS INT)"


def segment_rollup_sql(detail: str = "TargetGroupIndexRollOld_org") -> str:
    arms = " ".join(f"WHEN {detail} IN {members} THEN {group}" for group, members in DETAIL_ROLLUP.items())
    return f"CASE {arms} END"


def repeat_customer_sql(params: Params) -> str:
    """1 for accounts opened in S2 that also had demand in S2."""
    s2 = params.period(2)
    opened = f"accountDate BETWEEN {day_literal(s2.lo)} AND {day_literal(s2.hi)}"
    return f"CASE WHEN {opened} AND bbwS2 > 0 THEN 1 ELSE 0 END"


def demand_prepared(params: Params) -> dict[str, str]:
    """Columns that place a position in the calendar of the reporting date, once for all slots: its half
    year by number and its demand in cents (whole numbers sum faster)."""
    cents = f"CASE WHEN rectype = {DEMAND} THEN CAST(kpivaluevk * 100 AS BIGINT) END"
    return {"reported_in": period_number_sql("reportingdate", params.periods), "demand_cents": cents}


def demand_slots(params: Params) -> dict[str, str]:
    """Sums from which segments and inactivity follow, by column: demand in cents per half year of the
    reporting date, and demand since the inactivity horizon of accounts at least that old."""
    since = day_literal(params.inactive_since)
    slots = {f"bbw{p.name}": f"sum(CASE WHEN reported_in = {k} THEN demand_cents END)" for k, p in enumerate(params.periods)}
    return slots | {"nf": f"sum(CASE WHEN accountDate <= {since} AND reportingdate >= {since} THEN demand_cents END)"}


def is_recent_demand(positions: DataFrame, params: Params) -> Column:
    """Filter form: positions that ``demand_slots`` may count."""
    since = min(params.inactive_since, *(p.lo for p in params.periods))
    return (F.col("rectype") == DEMAND) & in_days(positions, "reportingdate", lo=since)


def demand_profile(positions: DataFrame, params: Params) -> DataFrame:
    """``demand_by_period`` and ``recent_demand`` of all accounts, in cents, in one pass over the demand rows."""
    rows = positions.filter(is_recent_demand(positions, params))
    rows = rows.withColumns({name: F.expr(sql) for name, sql in demand_prepared(params).items()})
    return rows.groupBy(*ACCOUNT).agg(*[F.expr(f"{sql} AS {name}") for name, sql in demand_slots(params).items()])


def demand_profile_of(orders: DataFrame, params: Params) -> DataFrame:
    """``demand_profile`` from ``order_facts``."""
    return orders.groupBy(*ACCOUNT).agg(*[F.sum(name).alias(name) for name in demand_slots(params)])


def population(src: Sources, params: Params, demand: DataFrame | None = None) -> DataFrame:
    """One row per eligible account (and per address of it) with age, tenure and segments.

    ``demand`` is a ``demand_profile`` that is there already; else the positions are read for it. Whether an account is inactive follows from the same demand rows as its segment, so it is
    tested on the joined row instead of by a second read and an anti join. Partner 0 is the
    absent-key sentinel and is never treated as inactive.
    """
    inactive = (
        (F.col("bpid") != 0)
        & (F.col("accountDate") <= F.lit(params.inactive_since))
        & (F.coalesce(F.col("nf"), F.lit(0)) == 0)
    )
    accounts = absent_from(
        eligible_customers(src.customer_overview), excluded_partners(src.partner_exclusion, params), ["bpid"]
    )
    exprs = age_and_tenure_sql(params) | {
        "SalutationID": "salutationid",
        "TargetGroupIndexRoll": segment_sql(params),
        "TargetGroupIndexRollOld_org": segment_detail_sql(params),
        "NK3": repeat_customer_sql(params),
    }
    return (
        accounts.join(demand_profile(src.positions, params) if demand is None else demand, list(ACCOUNT), "left")
        .filter(~F.coalesce(inactive, F.lit(False)))
        .join(src.address_overview.select(*ACCOUNT), list(ACCOUNT), "left")
        .select(*ACCOUNT, *[F.expr(sql).alias(name) for name, sql in exprs.items()])
    )
