"""Newsletter funnel and permissions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwise.functions import valid_at
from rollwise.operators.periods import covering_range, period_sums
from rollwise.params import Params

FUNNEL = ("send", "clicked", "opened")


def newsletter_funnel(clicks: DataFrame, params: Params) -> DataFrame:
    """Newsletters sent, clicked and opened per partner and contact period."""
    periods = params.contact_periods
    rows = clicks.filter((F.col("firmid") == params.firm_id) & covering_range(clicks, "datum", periods))
    return rows.groupBy("bpid").agg(*period_sums("datum", periods, {f"{step}_": step for step in FUNNEL}))


def permissions_as_of(permission_hist: DataFrame, params: Params) -> DataFrame:
    """Push and newsletter permission in force on the as-of day, one row per account version."""
    in_force = valid_at(permission_hist, "valid_from", "valid_to", params.as_of)
    return permission_hist.filter(in_force).select("bpid", "accountDate", "push_perm", "nl_perm")
