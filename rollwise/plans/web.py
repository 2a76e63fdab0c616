"""Web session features per contact period and style views of the quarter.

A session counts once per session-history row valid for it. The history is therefore reduced to a
number of valid rows per session before the join, and every sum is weighted with that number: the
result equals joining all rows, but the join never multiplies them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwise.functions import style_category_sql, valid_at
from rollwise.operators.joins import HOT_SHARE, salted_join
from rollwise.operators.periods import assign_period, covering_range, period_columns
from rollwise.params import Params

WEB_MEASURES = (
    "avg_session_length",
    "pagevisits",
    "pagevisits_ads",
    "device_unique",
    "Sessions",
    "KVB",
    "WKA",
    "desktopAnz",
    "mobileBrowser",
    "mobileApp",
    "tablet",
)
# Device codes and client types of mobile sessions.
DESKTOP, MOBILE, TABLET = 0, 1, 2
BROWSER_CLIENT, APP_CLIENT = "1", "3"


def customer_sessions(session: DataFrame, params: Params) -> DataFrame:
    """Sessions of the shop client with a click, without test customers."""
    return session.filter(
        (F.col("mandant_id") == params.client_id) & (F.col("session_click") == 1) & (F.col("testkunde") == 0)
    )


def valid_history(
    session_hist: DataFrame, params: Params, day: date, keys: Sequence[str], closed: bool = False
) -> DataFrame:
    """Number of history rows in force on ``day`` per session."""
    in_force = valid_at(session_hist, "gilt_von", "gilt_bis", day, closed)
    return (
        session_hist.filter((F.col("mandant_id") == params.client_id) & in_force)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("versions"))
    )


# Sums per session, weighted with its valid history rows, and flags of a session.
SESSION_SUMS = {
    "length": "sum(session_length_sek)",
    "timed": "count(session_length_sek)",
    "pagevisits": "sum(page_visits)",
    "pagevisits_ads": "sum(page_visits_ads)",
    "desktopAnz": f"sum(CASE WHEN device = {DESKTOP} THEN 1 END)",
    "mobileBrowser": f"sum(CASE WHEN device = {MOBILE} AND shopapi_client_type = '{BROWSER_CLIENT}' THEN 1 END)",
    "mobileApp": f"sum(CASE WHEN device = {MOBILE} AND shopapi_client_type = '{APP_CLIENT}' THEN 1 END)",
    "tablet": f"sum(CASE WHEN device = {TABLET} THEN 1 END)",
}
SESSION_FLAGS = {
    "KVB": "kauf_bool = 0 AND page_visits_ads > 0",
    "WKA": "kauf_bool = 0 AND wkorb_fill_bool = 1",
}


def web_features_long(session: DataFrame, session_hist: DataFrame, params: Params) -> DataFrame:
    """The web measures, one row per customer and contact period with sessions.

    Sessions and devices are both counted distinct. After the join each row gives one item for its
    session, carrying the sums and flags, and an empty one for its device. Items combine per
    (customer, period, kind, id) before they shuffle, so the device items stay few, and counting
    the items of a kind gives its distinct number in the same pass as the sums.
    """
    sessions = assign_period(customer_sessions(session, params), "partition_date", params.contact_periods)
    per_session = sessions.groupBy(F.col("ktnr_glob").alias("bpid"), "wkorbid", "period", "device").agg(
        *[F.expr(f"{sql} AS {name}") for name, sql in SESSION_SUMS.items()],
        *[F.expr(f"max(CASE WHEN {sql} THEN 1 ELSE 0 END) AS {name}") for name, sql in SESSION_FLAGS.items()],
    )
    history = valid_history(session_hist, params, params.web_as_of, ["ktnr", "wkorbid"])
    joined = per_session.join(history.withColumnRenamed("ktnr", "bpid"), ["bpid", "wkorbid"])

    session_item = F.struct(
        F.lit(True).alias("is_session"),
        F.col("wkorbid").alias("id"),
        *[(F.col(name) * F.col("versions")).alias(name) for name in SESSION_SUMS],
        *SESSION_FLAGS,
    )
    device_item = F.struct(
        F.lit(False).alias("is_session"),
        F.col("device").cast("long").alias("id"),
        *[F.lit(None).cast("long").alias(name) for name in SESSION_SUMS],
        *[F.lit(0).alias(name) for name in SESSION_FLAGS],
    )
    per_item = (
        joined.select("bpid", "period", F.inline(F.array(session_item, device_item)))
        .groupBy("bpid", "period", "is_session", "id")
        .agg(
            *[F.sum(name).alias(name) for name in SESSION_SUMS],
            *[F.max(name).alias(name) for name in SESSION_FLAGS],
        )
    )
    distinct = {
        "device_unique": "count_if(NOT is_session AND id IS NOT NULL)",
        "Sessions": "count_if(is_session)",
    }
    features = {name: f"sum({name})" for name in (*SESSION_SUMS, *SESSION_FLAGS)} | distinct
    features["avg_session_length"] = "CASE WHEN sum(timed) > 0 THEN sum(length) / sum(timed) END"
    return per_item.groupBy("bpid", "period").agg(*[F.expr(f"{features[name]} AS {name}") for name in WEB_MEASURES])


def web_features_wide(
    session: DataFrame, session_hist: DataFrame, params: Params, names: Sequence[str] = WEB_MEASURES
) -> DataFrame:
    """The web measures ``names`` as columns ``<measure>_S<k>``, one row per customer."""
    long = web_features_long(session, session_hist, params)
    return period_columns(long, ["bpid"], params.contact_periods, names)


# Style categories with an output column of their own.
STYLE_COLUMNS = {
    "Dob": "dob",
    "Wae": "wae",
    "Haka": "haka",
    "Kika": "kika",
    "Wohnen": "wohnen",
    "Schuh": "schuhe",
    "Bade": "bade",
    "Sport": "sport",
    "Acc": "acc",
}
STYLE_OUTPUT = ("AnzFT_Q1", "AnzStyles_Q1", "dob_Styles_Q1")


def style_interest(
    session: DataFrame, session_hist: DataFrame, styleview: DataFrame, params: Params, hot_share: float = HOT_SHARE
) -> DataFrame:
    """Style categories and styles viewed per customer with sessions in the quarter.

    Views are counted per session and two-character style prefix, sessions per customer, history
    rows per session; the sums are products of these counts. The history end day counts as valid
    here. Sessions share an id only by accident, but id 0 stands for "none" and may be frequent:
    it never has views, and the joins on the id split such a hot id over many tasks.
    """
    quarter = params.quarter
    sessions = customer_sessions(session, params)
    sessions = (
        sessions.filter(covering_range(sessions, "partition_date", [quarter]))
        .groupBy(F.col("ktnr_glob").alias("bpid"), "wkorbid")
        .agg(F.count(F.lit(1)).alias("sessions"))
    )
    history = valid_history(session_hist, params, quarter.hi, ["wkorbid"], closed=True)
    views = (
        styleview.filter(
            (F.col("mandant_id") == params.client_id)
            & (F.col("wkorbid") > 0)
            & covering_range(styleview, "partition_date", [quarter])
        )
        .groupBy("wkorbid", F.substring(F.col("style_id").cast("string"), 1, 2).alias("prefix"))
        .agg(F.count("style_id").alias("styles"))
    )
    # Weighing by the session count lets the search for hot ids read the shuffle of ``sessions``.
    known = history.join(views, "wkorbid", "left")
    per_prefix = (
        salted_join(sessions, known, "wkorbid", F.col("bpid"), weight=F.col("sessions"), hot_share=hot_share)
        .groupBy("bpid", "prefix")
        .agg(F.sum(F.expr("sessions * versions * coalesce(styles, 0)")).alias("styles"))
        .withColumn("category", F.expr(style_category_sql("prefix")))
    )
    return per_prefix.groupBy("bpid").agg(
        F.count("prefix").alias("AnzFT_Q1"),
        F.sum("styles").alias("AnzStyles_Q1"),
        *[
            F.expr(f"sum(CASE WHEN category = '{category}' THEN styles ELSE 0 END)").alias(f"{column}_Styles_Q1")
            for category, column in STYLE_COLUMNS.items()
        ],
    )
