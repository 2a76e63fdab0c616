"""Assembly of the output tables.

Features joined by partner multiply rows when a partner has several accounts or permissions. The
spine holds each distinct resulting row once, on few columns, with the number of times it occurs.
Every other feature is unique per key and is joined onto the spine; the copies are written out at
the very end, inside the tasks, so they are never shuffled, joined, sorted or numbered one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollwise.functions.categories import CATEGORIES
from rollwise.operators.checks import duplicate_keys
from rollwise.operators.joins import salted_join
from rollwise.operators.numbering import number_rows
from rollwise.operators.periods import period_columns
from rollwise.operators.repeats import TIMES, repeat_rows, split_copies
from rollwise.params import Params
from rollwise.plans.contacts import FUNNEL, newsletter_funnel, permissions_as_of
from rollwise.plans.orders import order_quotes, profit_by_period
from rollwise.plans.population import ACCOUNT, POPULATION_COLUMNS, demand_profile_of, population, segment_rollup_sql
from rollwise.plans.positions import (
    ACTIVITY_MASKS,
    LIFETIME_NAMES,
    MEASURE_NAMES,
    activity_mask_sql,
    lifetime_kpis_of,
    mask_long,
    masked_sql,
    order_facts,
    period_kpis_of,
    with_activity,
    with_breadth,
    with_rates,
)
from rollwise.plans.web import STYLE_OUTPUT, WEB_MEASURES, style_interest, web_features_wide
from rollwise.sources.sinks import Stage, staging, write_durable
from rollwise.sources.sinks import stage as stage_in_shared_folder
from rollwise.sources.tables import Sources

# Position measures of one half year in output order.
PERIOD_MEASURES = (
    "Nabs_ges",
    "Nums_ges",
    "Orders_katbez",
    "telbweg",
    "brabs_ges",
    "brums_ges",
    "Retwert",
    "RetMenge",
    "RSQ",
    "RWQ",
    "NF_ges",
    "NFMenge_ges",
    "Orders_ges",
    "Orders_OLSArt",
    "onlbweg",
    "TexBM_ges",
    "SchuhBM_ges",
    "HakaBM_ges",
    "KikaBM_ges",
    "WaeBM_ges",
    "DobBM_ges",
    "RiesigBM_ges",
    "Nutzung_VKB",
)
MATERNITY = "Umstand_BM"
# How many half years have newsletter counts, order profit and breadth.
FUNNEL_PERIODS, PROFIT_OUTPUT_PERIODS, BREADTH_PERIODS = 6, 4, 6
# Position measures that the outputs are made of; breadth needs all categories.
ORDER_MEASURES = tuple(
    name
    for name in MEASURE_NAMES
    if name in (*PERIOD_MEASURES, MATERNITY, *ACTIVITY_MASKS.values(), *(f"{c}BM_ges" for c in CATEGORIES))
)
PERMISSIONS = ("push_perm", "nl_perm")
BREADTH = tuple(f"AnzSorti_S{k}" for k in range(1, BREADTH_PERIODS + 1))


def period_output(k: int) -> list[str]:
    """Masked columns of half year ``k`` in output order."""
    names = list(PERIOD_MEASURES)
    if k <= FUNNEL_PERIODS:
        names += FUNNEL
    names.append(MATERNITY)
    if k <= PROFIT_OUTPUT_PERIODS:
        names.append("orderprofit")
    return [f"{name}_S{k}" for name in names]


def account_features(orders: DataFrame, params: Params) -> DataFrame:
    """All position features, one row per account: half years, breadth, activity masks, lifetime.

    ``orders`` are the staged ``order_facts``, so the positions are read and dealt out once. Rates, masks
    and flags are computed while each half year is a row, that is once per measure instead of once per
    measure and half year; the age mask may be, because an account is joined to the population by its own
    opening date.
    """
    measures = [*PERIOD_MEASURES, MATERNITY]
    long = with_activity(with_breadth(with_rates(period_kpis_of(orders))))
    long = mask_long(long.select(*ACCOUNT, "period", *measures, "AnzSorti", *ACTIVITY_MASKS), params, measures)
    wide = period_columns(long, ACCOUNT, params.periods, [*measures, "AnzSorti", *ACTIVITY_MASKS])
    output = [name for k in range(1, len(params.periods) + 1) for name in period_output(k) if name in wide.columns]
    masks = [f"{activity_mask_sql(name)} AS {name}" for name in ACTIVITY_MASKS]
    wide = wide.selectExpr(*ACCOUNT, *output, *BREADTH, *masks)
    # Whoever has a half year has a lifetime; accounts without a key join nothing later.
    return lifetime_kpis_of(orders).join(wide, list(ACCOUNT), "left")


def breadth_choices(accounts: DataFrame) -> DataFrame:
    """Per partner and half year, the breadth values of its accounts and how many accounts have each.

    A breadth is 0 to 9, so a list has at most ten entries however many accounts a partner has.
    """
    stacked = ", ".join(f"{k}, AnzSorti_S{k}" for k in range(1, BREADTH_PERIODS + 1))
    values = (
        accounts.select("bpid", F.expr(f"stack({BREADTH_PERIODS}, {stacked}) AS (k, breadth)"))
        .filter(F.col("breadth").isNotNull())
        .groupBy("bpid", "k", "breadth")
        .agg(F.count(F.lit(1)).alias("accounts"))
    )
    return values.groupBy("bpid").agg(
        *[
            F.collect_list(F.when(F.col("k") == k, F.struct("breadth", "accounts"))).alias(name)
            for k, name in enumerate(BREADTH, start=1)
        ]
    )


def permission_choices(permission_hist: DataFrame, params: Params) -> DataFrame:
    """Per partner, the distinct permissions in force and how many rows have each."""
    return (
        permissions_as_of(permission_hist, params)
        .groupBy("bpid", *PERMISSIONS)
        .agg(F.count(F.lit(1)).alias("permission_rows"))
    )


def spine(people: DataFrame, accounts: DataFrame, permission_hist: DataFrame, params: Params) -> DataFrame:
    """The population with permissions and breadth, which are joined by partner only.

    A partner with several permission rows, or several accounts with positions in a half year,
    multiplies the rows of the population; a missing half year counts as breadth 0. Equal rows
    stay one row, with their number multiplied into ``_times``. Both tables are put together first, so
    the population is joined once, and a partner with much of it, or rows without a partner, are dealt
    to several tasks, where they are also multiplied.
    """
    choices = permission_choices(permission_hist, params).join(breadth_choices(accounts), "bpid", "full")
    rows = salted_join(people, choices, "bpid", F.xxhash64(*people.columns), "left")
    for name in BREADTH:
        rows = rows.withColumn(name, F.explode_outer(name))
    factors = [TIMES, "coalesce(permission_rows, 1L)", *[f"coalesce({name}.accounts, 1L)" for name in BREADTH]]
    return rows.withColumns(
        {TIMES: F.expr(" * ".join(factors))} | {name: F.expr(f"coalesce({name}.breadth, 0)") for name in BREADTH}
    ).drop("permission_rows")


def weighted(rows: DataFrame, power: int) -> DataFrame:
    """Rows with ``_times`` as after joining ``power`` tables that repeat each account as ``rows`` does."""
    if power == 0:
        return rows.withColumn(TIMES, F.lit(1).cast("long"))
    # A missing partner matches nothing, not even itself; such rows are dealt by all they hold.
    apart = F.when(F.col("bpid").isNull(), F.xxhash64(*rows.columns))
    same = F.when(F.col("bpid").isNotNull(), F.count(F.lit(1)).over(Window.partitionBy(*ACCOUNT, apart))).otherwise(1)
    counted = rows.withColumn("_same", same)
    return counted.withColumn(TIMES, F.expr(" * ".join(["_same"] * power))).drop("_same")


def partner_features(src: Sources, params: Params, web: bool = True) -> DataFrame:
    """Newsletter, profit and (with ``web``) web features: all that is joined by partner alone."""
    parts = [newsletter_funnel(src.clicks, params), profit_by_period(src.order_profit, params)]
    if web:
        parts.append(web_features_wide(src.session, src.session_hist, params))
        parts.append(style_interest(src.session, src.session_hist, src.styleview, params).select("bpid", *STYLE_OUTPUT))
    # The columns of a part pass the joins as one: the method that hands on a row of a full join would
    # become too long to be compiled with all of them.
    packed = [
        part.filter("bpid IS NOT NULL").select("bpid", F.struct(*[c for c in part.columns if c != "bpid"]).alias(f"part{k}"))
        for k, part in enumerate(parts)
    ]
    joined = reduce(lambda left, right: left.join(right, "bpid", "full"), packed)
    return joined.select("bpid", *[f"part{k}.*" for k in range(len(parts))])


def with_features(rows: DataFrame, accounts: DataFrame, partners: DataFrame, params: Params) -> DataFrame:
    """Join partner and account features onto the spine; mask what is joined by partner."""
    joined = rows.join(partners, "bpid", "left").join(accounts.drop(*BREADTH), list(ACCOUNT), "left")
    masked = {f"{name}_S{k}": k for k in range(1, FUNNEL_PERIODS + 1) for name in FUNNEL}
    masked |= {f"orderprofit_S{k}": k for k in range(1, PROFIT_OUTPUT_PERIODS + 1)}
    masked |= {name: k for k, name in enumerate(BREADTH, start=1)}
    changed = {name: masked_sql(name, params, k) for name, k in masked.items()}
    changed |= {name: f"coalesce({name}, 0)" for name in ACTIVITY_MASKS}
    return joined.selectExpr(*[f"{changed[c]} AS {c}" if c in changed else c for c in joined.columns])


def transaction_columns(params: Params) -> list[str]:
    """The 233 transaction features in output order."""
    periods = [name for k in range(1, len(params.periods) + 1) for name in period_output(k)]
    return [*periods, *LIFETIME_NAMES, *PERMISSIONS, *BREADTH, *ACTIVITY_MASKS]


def web_columns(params: Params) -> list[str]:
    """The 69 web features in output order."""
    return [f"{name}_{p.name}" for p in params.contact_periods for name in WEB_MEASURES] + list(STYLE_OUTPUT)


@dataclass(frozen=True)
class Inputs:
    """Sources together with the intermediates that all outputs share."""

    src: Sources
    params: Params
    people: DataFrame
    accounts: DataFrame
    partners: DataFrame
    stage: Stage


def prepare(
    src: Sources,
    params: Params,
    stage: Stage = stage_in_shared_folder,
    people: DataFrame | None = None,
    web: bool = True,
    orders: DataFrame | None = None,
) -> Inputs:
    """Stage what the outputs share; take population and order facts as given or derive them.

    The positions are read once: the population's demand comes from the order facts too.
    """
    if orders is None:
        orders = stage(order_facts(src.positions, params, ORDER_MEASURES), "orders")
    if people is None:
        people = stage(population(src, params, demand_profile_of(orders, params)), "population")
    # One row per account, read by the joins of two outputs: bucketed, neither has to move it again. The
    # other sides of partner joins may hold a partner many times, so these are left for Spark to split.
    accounts = stage(account_features(orders, params), "accounts", bucket_by=ACCOUNT)
    partners = stage(partner_features(src, params, web), "partners")
    return Inputs(src, params, people, accounts, partners, stage)


def transactions(inputs: Inputs) -> DataFrame:
    """Keys, age and the 233 transaction features."""
    src, params = inputs.src, inputs.params
    # The activity masks are joined from a table with one row per population row.
    people = weighted(inputs.people, 1)
    # Staged, so that the join with the wide partner features has an exchange of its own and Spark can
    # split a partner with very many accounts there.
    rows = split_copies(inputs.stage(spine(people, inputs.accounts, src.permission_hist, params), "spine"))
    rows = repeat_rows(with_features(rows, inputs.accounts, inputs.partners, params))
    return rows.select(*ACCOUNT, "Age", *transaction_columns(params))


def webshop(people: DataFrame, src: Sources, params: Params, partners: DataFrame | None = None) -> DataFrame:
    """Keys and the 69 web features, from staged partner features or from the sources."""
    if partners is None:
        sessions = web_features_wide(src.session, src.session_hist, params)
        styles = style_interest(src.session, src.session_hist, src.styleview, params)
        rows = people.select(*ACCOUNT).join(sessions, "bpid", "left").join(styles, "bpid", "left")
    else:
        rows = people.select(*ACCOUNT).join(partners, "bpid", "left")
    return rows.select(*ACCOUNT, *web_columns(params))


def full(inputs: Inputs) -> DataFrame:
    """The final table: population, both datamarts, the rolled-up segment and a number per segment.

    Numbers follow the population columns, then permissions and breadth; rows equal in all of these are
    equal altogether, so a run can be repeated.
    """
    src, params = inputs.src, inputs.params
    # The activity masks, the transactions and the web features each repeat an account as often as
    # the population does, and are joined by account.
    people = weighted(inputs.people, 3).withColumns(
        {
            "CustomerID": F.col("bpid"),
            "TargetGroupindexRollOld": F.expr(segment_rollup_sql()),
        }
    )
    rows = spine(people, inputs.accounts, src.permission_hist, params)
    groups = ["TargetGroupIndexRoll", "TargetGroupindexRollOld"]
    order = [*[c for c in POPULATION_COLUMNS if c not in groups], *PERMISSIONS, *BREADTH]
    numbered = split_copies(number_rows(rows, groups, order, inputs.stage, weight=TIMES), "rownumber")
    wide = with_features(numbered, inputs.accounts, inputs.partners, params)
    # Without a partner there is no row of the transactions to take these defaults from.
    defaults = {name: F.when(F.col("bpid").isNotNull(), F.col(name)) for name in (*BREADTH, *ACTIVITY_MASKS)}
    return repeat_rows(wide.withColumns(defaults), number="rownumber").select(*datamart_columns(params))


def datamart_transactions(src: Sources, params: Params) -> DataFrame:
    return transactions(prepare(src, params, web=False))


def datamart_webshop(src: Sources, params: Params) -> DataFrame:
    return webshop(population(src, params), src, params)


def datamart(src: Sources, params: Params, stage: Stage = stage_in_shared_folder) -> DataFrame:
    """The final table; ``with staging(spark) as stage`` removes its intermediates after use."""
    return full(prepare(src, params, stage))


# The durable outputs, in the order in which they are written.
OUTPUTS = ("population", "order_quotes", "datamart_transactions", "datamart_webshop", "datamart")
# Beside them: how many keys occur how often in what the outputs are joined with by one key.
KEY_COUNTS = "duplicate_keys"


def key_counts(src: Sources) -> DataFrame:
    """Per source of a partner join: keys that occur more than once, their rows, the most of one key."""
    checked = {"permission_hist": ["bpid"], "customer_overview": ["bpid"], "address_overview": list(ACCOUNT)}
    counts = [
        duplicate_keys(getattr(src, name), *keys)
        .agg(F.count("*").alias("keys"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"), F.max("row_count").alias("most"))
        .select(F.lit(name).alias("source"), "keys", "rows", "most")
        for name, keys in checked.items()
    ]
    return reduce(DataFrame.union, counts)


def write_outputs(src: Sources, params: Params, database: str | None = None) -> None:
    """Create or replace the five output tables and the key counts.

    The positions are read once, for the order facts. The population is written first and read by the
    others. What they share is staged once and removed at the end.
    """

    def write(name: str, df: DataFrame) -> DataFrame:
        table = f"{database}.{name}" if database else name
        write_durable(df, table)
        return df.sparkSession.table(table)

    with staging(src.positions.sparkSession) as stage:
        write(KEY_COUNTS, key_counts(src))
        orders = stage(order_facts(src.positions, params, ORDER_MEASURES), "orders")
        people = write("population", population(src, params, demand_profile_of(orders, params)))
        inputs = prepare(src, params, stage, people, orders=orders)
        write("order_quotes", order_quotes(people, src.order_profit, params))
        write("datamart_transactions", transactions(inputs))
        write("datamart_webshop", webshop(people, src, params, inputs.partners))
        write("datamart", full(inputs))


def datamart_columns(params: Params) -> list[str]:
    """Columns of ``datamart`` in order."""
    return [
        *POPULATION_COLUMNS,
        "CustomerID",
        "TargetGroupindexRollOld",
        *transaction_columns(params),
        *web_columns(params),
        "rownumber",
    ]
