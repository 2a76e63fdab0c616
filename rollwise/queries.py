"""The registered queries: each operator and feature of the engine over the sample sources."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwise.functions import in_days, round_to_long, valid_at
from rollwise.operators import absent_from, assign_period, duplicate_keys, number_rows, repeat_rows, split_copies
from rollwise.operators.periods import period_columns
from rollwise.params import Params
from rollwise.plans import contacts, datamart, orders, population, positions, store, web
from rollwise.plans.population import ACCOUNT
from rollwise.sources import Sources, refresh_partitions, refreshed, sample_params, sample_sources, session_folder, stage

Query = Callable[[Sources, Params], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name](sample_sources(spark, sf_dir), sample_params())


def _rows() -> Column:
    return F.count(F.lit(1)).alias("row_count")


# --- scans and sources ---------------------------------------------------------------------------


@query
def src_positions_adapter(src: Sources, params: Params) -> DataFrame:
    return src.positions.groupBy("rectype", "catalogtypeid", "orderchannelcd", "itemsize").agg(
        _rows(),
        F.countDistinct("bpid").alias("partners"),
        F.sum("kpivalueqty").alias("qty"),
        F.sum("kpivaluevk").alias("vk"),
        F.to_date(F.min("orderdate")).alias("first_order"),
        F.to_date(F.max("reportingdate")).alias("last_report"),
        F.max("promotionpurchasecd").alias("last_code"),
    )


@query
def scan_date_range(src: Sources, params: Params) -> DataFrame:
    s2 = params.period(2)
    rows = src.positions.filter(
        in_days(src.positions, "orderdate", s2.lo, s2.hi)
        & in_days(src.positions, "reportingdate", s2.lo, s2.last_reporting_day)
    )
    return rows.groupBy("bpid", "rectype").agg(_rows(), F.sum("kpivaluevk").alias("vk"))


@query
def scan_partition_pruned(src: Sources, params: Params) -> DataFrame:
    s2 = params.contact_periods[1]
    stored = stage(src.session, "session", "partition_date")
    rows = stored.filter(in_days(stored, "partition_date", s2.lo, s2.hi))
    return rows.groupBy("partition_date").agg(_rows(), F.sum("page_visits").alias("visits"))


@query
def refresh_range(src: Sources, params: Params) -> DataFrame:
    stale = src.positions.withColumn("kpivaluevk", F.lit(0).cast("decimal(18,2)"))
    fresh = refreshed(stale, src.positions, "reportingdate", params.period(2).lo, params.period(1).hi)
    return fresh.groupBy(F.to_date("reportingdate").alias("reporting_day")).agg(
        _rows(), F.sum("kpivaluevk").alias("vk")
    )


@query
def refresh_table(src: Sources, params: Params) -> DataFrame:
    """A refresh as it is run on a stored table: the partitions of the range are overwritten, and that of
    a day the source has lost goes, here from an external table."""
    spark = src.session.sparkSession
    rows = src.session.select("ktnr_glob", "wkorbid", "page_visits", "partition_date")
    stale = rows.withColumn("page_visits", F.lit(0).cast("long"))
    name = f"refreshed_{uuid4().hex}"
    writer = stale.repartition("partition_date").write.partitionBy("partition_date").format("parquet")
    writer.option("path", f"{session_folder(spark)}/{name}").saveAsTable(name)
    newest, second = params.contact_periods[:2]
    without_a_day = rows.filter(F.col("partition_date") != F.lit(second.hi))
    refresh_partitions(without_a_day, name, "partition_date", second.lo, newest.hi)
    return spark.table(name).groupBy("partition_date").agg(_rows(), F.sum("page_visits").alias("visits"))


@query
def scalar_semantics(src: Sources, params: Params) -> DataFrame:
    return src.positions.select(
        "bpid",
        "orderid",
        "rectype",
        round_to_long(F.col("kpivaluevk")).alias("rounded_value"),
        round_to_long(F.col("kpivaluevk") / 2).alias("rounded_half"),
        F.round(F.col("kpivalueqty").cast("double") / 7, 3).alias("rounded_ratio"),
        F.to_date("reportingdate").alias("reporting_day"),
        F.date_sub(F.to_date("orderdate"), 35).alias("days_before"),
        F.date_add(F.to_date("orderdate"), 35).alias("days_after"),
        F.datediff("reportingdate", "orderdate").alias("lag_days"),
        F.upper("orderchannelcd").alias("channel"),
        F.substring("promotionpurchasecd", 1, 2).alias("prefix"),
        F.coalesce("catalogtypeid", F.lit(0)).alias("catalog"),
        F.col("orderid").cast("string").alias("order_text"),
        F.expr("CASE WHEN orderid > 0 THEN bpid / orderid END").alias("guarded"),
    )


# --- periods -------------------------------------------------------------------------------------


@query
def period_assign(src: Sources, params: Params) -> DataFrame:
    placed = assign_period(src.positions, "orderdate", params.periods)
    return placed.groupBy("period", "rectype").agg(
        _rows(), F.countDistinct("bpid").alias("partners"), F.sum("kpivaluevk").alias("vk")
    )


@query
def positions_grace_window(src: Sources, params: Params) -> DataFrame:
    lag = F.datediff("reportingdate", "orderdate")
    return positions.period_positions(src.positions, params).groupBy("bpid", "period").agg(
        _rows(), F.max(lag).alias("longest_lag"), F.sum("kpivalueqty").alias("qty")
    )


# --- population ----------------------------------------------------------------------------------


@query
def agg_grouped_sum(src: Sources, params: Params) -> DataFrame:
    return population.recent_demand(src.positions, params)


@query
def demand_by_period(src: Sources, params: Params) -> DataFrame:
    return population.demand_by_period(src.positions, params)


def _with_demand(src: Sources, params: Params) -> DataFrame:
    customers = population.eligible_customers(src.customer_overview)
    return customers.join(population.demand_by_period(src.positions, params), list(ACCOUNT), "left")


@query
def segment_recency(src: Sources, params: Params) -> DataFrame:
    segment = F.expr(population.segment_sql(params)).alias("TargetGroupIndexRoll")
    return _with_demand(src, params).select(*ACCOUNT, segment)


@query
def segment_recency_detail(src: Sources, params: Params) -> DataFrame:
    detail = F.expr(population.segment_detail_sql(params)).alias("TargetGroupIndexRollOld_org")
    return _with_demand(src, params).select(*ACCOUNT, detail)


@query
def segment_rollup(src: Sources, params: Params) -> DataFrame:
    rollup = F.expr(population.segment_rollup_sql()).alias("TargetGroupindexRollOld")
    return segment_recency_detail(src, params).select(*ACCOUNT, rollup)


@query
def flag_nk3(src: Sources, params: Params) -> DataFrame:
    flag = F.expr(population.repeat_customer_sql(params)).alias("NK3")
    return _with_demand(src, params).select(*ACCOUNT, flag)


@query
def age_and_tenure(src: Sources, params: Params) -> DataFrame:
    exprs = population.age_and_tenure_sql(params)
    return population.eligible_customers(src.customer_overview).select(
        *ACCOUNT, *[F.expr(sql).alias(name) for name, sql in exprs.items()]
    )


@query
def inactive_accounts(src: Sources, params: Params) -> DataFrame:
    return population.inactive_accounts(src, params)


@query
def anti_join_inactive(src: Sources, params: Params) -> DataFrame:
    customers = population.eligible_customers(src.customer_overview)
    return absent_from(customers, population.inactive_accounts(src, params), ACCOUNT).select(*ACCOUNT)


@query
def anti_join_exclusion(src: Sources, params: Params) -> DataFrame:
    customers = population.eligible_customers(src.customer_overview)
    excluded = population.excluded_partners(src.partner_exclusion, params)
    return absent_from(customers, excluded, ["bpid"]).select(*ACCOUNT)


@query
def population_base(src: Sources, params: Params) -> DataFrame:
    return population.population(src, params)


@query
def join_left_composite(src: Sources, params: Params) -> DataFrame:
    people = population.population(src, params).select(*ACCOUNT)
    return people.join(population.demand_by_period(src.positions, params), list(ACCOUNT), "left")


@query
def join_left_single_key(src: Sources, params: Params) -> DataFrame:
    people = population.population(src, params).select(*ACCOUNT)
    return people.join(contacts.newsletter_funnel(src.clicks, params), "bpid", "left")


@query
def key_uniqueness(src: Sources, params: Params) -> DataFrame:
    return duplicate_keys(src.permission_hist, "bpid")


# --- positions -----------------------------------------------------------------------------------


@query
def sum_of_rounded(src: Sources, params: Params) -> DataFrame:
    return src.positions.groupBy(*ACCOUNT, "rectype").agg(
        F.sum(round_to_long(F.col("kpivaluevk"))).alias("sum_rounded"), F.sum("kpivaluevk").alias("sum_exact")
    )


def _long(src: Sources, params: Params, *names: str) -> DataFrame:
    return positions.position_kpis_long(src.positions, params, names)


@query
def measure_net_gross_returns(src: Sources, params: Params) -> DataFrame:
    return _long(
        src, params, "Nabs_ges", "Nums_ges", "StornoMenge_ges", "StornoWert_ges", "brabs_ges", "brums_ges",
        "Retwert", "RetMenge", "NF_ges", "NFMenge_ges",
    )


@query
def measure_catalog_split(src: Sources, params: Params) -> DataFrame:
    return _long(
        src, params, "Nabs_online", "Nums_online", "Nabs_katbez", "Nums_katbez", "Orders_katbez",
        "Orders_ges", "Orders_OLSArt", "Nutzung_VKB",
    )


@query
def measure_channel_flags(src: Sources, params: Params) -> DataFrame:
    return _long(src, params, "telbweg", "onlbweg")


@query
def measure_categories(src: Sources, params: Params) -> DataFrame:
    names = [f"{name}BM_ges" for name in positions.CATEGORIES]
    return _long(src, params, *names, "Umstand_BM")


@query
def measure_big_size(src: Sources, params: Params) -> DataFrame:
    return _long(src, params, "RiesigBM_ges")


@query
def position_kpis_long(src: Sources, params: Params) -> DataFrame:
    return positions.position_kpis_long(src.positions, params)


@query
def position_kpis_wide(src: Sources, params: Params) -> DataFrame:
    return positions.position_kpis_wide(src.positions, params)


@query
def lifetime_kpis(src: Sources, params: Params) -> DataFrame:
    return positions.lifetime_kpis(src.positions, params)


@query
def lifetime_store(src: Sources, params: Params) -> DataFrame:
    """``lifetime_kpis`` from a store that was made before the newest half year was known."""
    spark = src.positions.sparkSession
    name = f"lifetime_{uuid4().hex}"
    newest = params.period(1)
    store.create_store(src.positions.filter(~in_days(src.positions, "reportingdate", newest.lo, newest.hi)), name, f"{session_folder(spark)}/{name}")
    store.refresh_store(src.positions, name, newest.lo, newest.hi)
    return store.lifetime_kpis_from(spark.table(name), params)


@query
def return_rates(src: Sources, params: Params) -> DataFrame:
    long = positions.with_rates(_long(src, params, "Retwert", "RetMenge", "Nabs_ges", "Nums_ges"))
    return period_columns(long, ACCOUNT, params.periods, list(positions.RATES))


@query
def assortment_breadth(src: Sources, params: Params) -> DataFrame:
    long = positions.with_breadth(_long(src, params, *[f"{name}BM_ges" for name in positions.CATEGORIES]))
    accounts = period_columns(long, ACCOUNT, params.periods, ["AnzSorti"])
    people = datamart.weighted(population.population(src, params).select(*ACCOUNT), 0)
    rows = repeat_rows(split_copies(datamart.spine(people, accounts, src.permission_hist, params)))
    return rows.select(
        *ACCOUNT,
        *[
            F.expr(positions.masked_sql(name, params, k)).alias(name)
            for k, name in enumerate(datamart.BREADTH, start=1)
        ],
    )


@query
def activity_bitmask(src: Sources, params: Params) -> DataFrame:
    masks = list(positions.ACTIVITY_MASKS)
    long = positions.with_activity(_long(src, params, *positions.ACTIVITY_MASKS.values()))
    wide = period_columns(long, ACCOUNT, params.periods, masks)
    people = population.population(src, params).select(*ACCOUNT).join(wide, list(ACCOUNT), "left")
    return people.selectExpr(*ACCOUNT, *[f"{positions.activity_mask_sql(name)} AS {name}" for name in masks])


@query
def mask_by_account_age(src: Sources, params: Params) -> DataFrame:
    wide = positions.position_kpis_wide(src.positions, params, ("NF_ges", "Orders_ges"))
    people = population.population(src, params).select(*ACCOUNT).join(wide, list(ACCOUNT), "left")
    return people.select(
        *ACCOUNT,
        *[
            F.expr(positions.masked_sql(f"{name}_S{k}", params, k)).alias(f"{name}_S{k}")
            for k in range(1, len(params.periods) + 1)
            for name in ("NF_ges", "Orders_ges")
        ],
    )


# --- orders, newsletter, permissions -------------------------------------------------------------


@query
def orders_distinct_by_period(src: Sources, params: Params) -> DataFrame:
    return orders.order_counts(src.order_profit, params, params.periods)


@query
def orders_composite_periods(src: Sources, params: Params) -> DataFrame:
    return orders.order_counts(src.order_profit, params, params.composite_periods())


@query
def order_quotes(src: Sources, params: Params) -> DataFrame:
    return orders.order_quotes(population.population(src, params), src.order_profit, params)


@query
def profit_by_period(src: Sources, params: Params) -> DataFrame:
    return orders.profit_by_period(src.order_profit, params)


@query
def newsletter_funnel(src: Sources, params: Params) -> DataFrame:
    return contacts.newsletter_funnel(src.clicks, params)


@query
def asof_permission(src: Sources, params: Params) -> DataFrame:
    return contacts.permissions_as_of(src.permission_hist, params)


@query
def asof_closed(src: Sources, params: Params) -> DataFrame:
    history = src.session_hist
    closed = valid_at(history, "gilt_von", "gilt_bis", params.quarter.hi, closed=True)
    half_open = valid_at(history, "gilt_von", "gilt_bis", params.quarter.hi)
    return history.groupBy("ktnr").agg(
        F.count_if(closed).alias("valid_closed"), F.count_if(half_open).alias("valid_half_open")
    )


# --- web -----------------------------------------------------------------------------------------


@query
def web_session_features(src: Sources, params: Params) -> DataFrame:
    return web.web_features_long(src.session, src.session_hist, params)


@query
def web_device_mix(src: Sources, params: Params) -> DataFrame:
    names = ("device_unique", "desktopAnz", "mobileBrowser", "mobileApp", "tablet")
    return web.web_features_wide(src.session, src.session_hist, params, names)


@query
def web_abandonment(src: Sources, params: Params) -> DataFrame:
    return web.web_features_wide(src.session, src.session_hist, params, ("Sessions", "KVB", "WKA"))


@query
def style_interest(src: Sources, params: Params) -> DataFrame:
    return web.style_interest(src.session, src.session_hist, src.styleview, params)


# --- assembly ------------------------------------------------------------------------------------


@query
def star_except(src: Sources, params: Params) -> DataFrame:
    people = population.population(src, params)
    profit = orders.profit_by_period(src.order_profit, params).withColumnRenamed("bpid", "profit_bpid")
    return people.join(profit, F.col("bpid") == F.col("profit_bpid"), "left").drop("profit_bpid", "Age", "NK3")


@query
def segment_row_number(src: Sources, params: Params) -> DataFrame:
    people = population.population(src, params).select(
        *ACCOUNT, "TargetGroupIndexRoll", F.expr(population.segment_rollup_sql()).alias("TargetGroupindexRollOld")
    )
    return number_rows(people, ["TargetGroupIndexRoll", "TargetGroupindexRollOld"], ACCOUNT, stage)


@query
def datamart_transactions(src: Sources, params: Params) -> DataFrame:
    return datamart.datamart_transactions(src, params)


@query
def datamart_webshop(src: Sources, params: Params) -> DataFrame:
    return datamart.datamart_webshop(src, params)


@query
def datamart_full(src: Sources, params: Params) -> DataFrame:
    return datamart.datamart(src, params)
