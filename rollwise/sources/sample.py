"""The ten inputs derived from the generic sales tables (customer, orders, lineitem, part, events).

All rows of those tables are used. Keys are shifted by one because 0 means "absent" for the engine;
a few customers get the key 0 after all. Some partners have two accounts, some accounts two
addresses, some partners two permissions in force, sessions have 0, 1 or 2 history rows, and some
share an id, so that joins multiply rows as they do in real tables. The time spans differ: orders end on 2001-08-01, events on 2024-01-30, so the sample
parameters anchor the two groups of sources apart. Birth dates are plain dates.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwise.params import Params, equal_periods
from rollwise.sources.tables import Sources, schema_of

ORDER_ANCHOR = date(2001, 8, 2)
WEB_ANCHOR = date(2024, 1, 31)


def sample_params() -> Params:
    return Params(
        anchor=ORDER_ANCHOR,
        contact_periods=equal_periods(WEB_ANCHOR, days=5, count=6),
        quarter=equal_periods(WEB_ANCHOR, days=10, count=1, prefix="Q")[0],
    )


def partner(key: str) -> str:
    """SQL for the partner of a customer or user; two share the key 0. Every further account of a
    partner multiplies its rows in the final table many times, so their number must not grow."""
    return f"CASE WHEN {key} IN (57, 45) THEN 0 ELSE {key} + 1 END"


# Sessions without an id of their own: the id 0, or that of the session before.
SESSION_ID = "CASE WHEN event_id % 31 = 0 THEN 0 WHEN event_id % 37 = 0 THEN event_id ELSE event_id + 1 END"


def sample_sources(spark: SparkSession, sf_dir: str) -> Sources:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def shaped(name: str, df: DataFrame, **columns: str) -> DataFrame:
        return df.selectExpr(
            *[f"CAST({columns[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema_of(name).fields]
        )

    customer, orders, events = table("customer"), table("orders"), table("events")
    opened = "date_add(DATE'1995-01-01', CAST(c_custkey * 37 % 2400 AS INT))"
    second = f"CASE WHEN c_custkey % 190 = 7 THEN date_add({opened}, 200) END"
    both = f"CASE WHEN c_custkey % 97 != 96 THEN array_compact(array({opened}, {second})) ELSE array(CAST(NULL AS DATE)) END"
    customers = shaped(
        "customer_overview",
        customer.withColumn("opened", F.explode(F.expr(both))),
        bpid=partner("c_custkey"),
        accountDate="opened",
        bptypeid="CASE c_mktsegment WHEN 'MACHINERY' THEN 'Z002' WHEN 'AUTOMOBILE' THEN 'Z019' ELSE 'Z001' END",
        birthdate="date_add(DATE'1940-01-01', CAST(c_custkey * 101 % 25000 AS INT))",
        salutationid="c_nationkey % 3",
    )
    sizes = table("part").select("p_partkey", "p_size")
    # Values of an order are derived once per order.
    placed = orders.selectExpr(
        "o_orderkey",
        "o_custkey",
        # Some orders come late in the evening of their day.
        "CAST(o_orderdate AS TIMESTAMP_NTZ) + IF(o_orderkey % 5 = 0, INTERVAL '86399' SECOND, INTERVAL '0' SECOND) AS ordered",
        "CAST(o_orderdate AS DATE) AS order_day",
        "CASE o_orderkey % 9 WHEN 0 THEN 'I' WHEN 1 THEN 'i' WHEN 2 THEN 'T' WHEN 3 THEN 't' WHEN 4 THEN 'S' "
        "WHEN 5 THEN 's' WHEN 6 THEN NULL ELSE o_orderpriority END AS channel",
        "o_orderstatus",
        "o_orderpriority",
    )
    owned = placed.join(customers.select("bpid", "accountDate"), F.expr(partner("o_custkey")) == F.col("bpid"))
    # Joined by order last, so that an order's lines stay together for whoever groups by order.
    lines = (
        table("lineitem")
        .join(sizes, F.col("l_partkey") == F.col("p_partkey"))
        .join(owned, F.col("l_orderkey") == F.col("o_orderkey"))
        # Values of a line are derived once; then it yields one row per record type it takes part in.
        .selectExpr(
            "bpid",
            "accountDate",
            "ordered",
            "CAST(date_add(order_day, 7 * l_linenumber) AS TIMESTAMP_NTZ) AS reportingdate",
            "o_orderkey",
            "CAST(l_quantity AS DECIMAL(18,2)) AS quantity",
            "CAST(l_extendedprice AS DECIMAL(18,2)) AS price",
            "l_returnflag",
            "CASE l_suppkey % 4 WHEN 0 THEN 20 WHEN 1 THEN 60 WHEN 2 THEN 10 END AS catalogtypeid",
            "channel",
            "IF(l_partkey % 41 = 0, '4', CAST(100 + l_partkey * 7 % 800 AS STRING)) AS code",
            "CASE WHEN p_size >= 46 THEN 'XL' ELSE CAST(p_size AS STRING) END AS size",
            """explode(array(
                CASE WHEN o_orderstatus != 'F' THEN 1 END,
                CASE WHEN l_returnflag = 'A' THEN 3 ELSE 5 END,
                CASE l_returnflag WHEN 'R' THEN 6 WHEN 'N' THEN 91 END,
                CASE WHEN o_orderpriority = '5-LOW' AND l_linenumber = 1 THEN 701 END)) AS rectype""",
        )
        .filter("rectype IS NOT NULL")
    )
    positions = shaped(
        "positions",
        lines,
        bpid="bpid",
        accountDate="accountDate",
        orderdate="ordered",
        reportingdate="reportingdate",
        rectype="rectype",
        orderid="o_orderkey",
        kpivalueqty="quantity",
        kpivaluevk="CASE WHEN rectype = 1 AND l_returnflag = 'A' THEN -price ELSE price END",
        catalogtypeid="catalogtypeid",
        orderchannelcd="channel",
        promotionpurchasecd="code",
        itemsize="size",
    )
    exclusions = shaped(
        "partner_exclusion",
        customer,
        bpid=partner("c_custkey"),
        exclusioncd="c_custkey % 53",
        decisionfg="CASE WHEN c_custkey % 7 = 6 THEN 0 ELSE 1 END",
        validfrom="TIMESTAMP_NTZ'1996-01-01 00:00:00'",
        validto="""CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP_NTZ'2001-08-01 00:00:00'
            ELSE TIMESTAMP_NTZ'2099-12-31 00:00:00' END""",
    )
    profit = shaped(
        "order_profit",
        orders,
        bpid=partner("o_custkey"),
        reportingdate="o_orderdate",
        orderid="o_orderkey",
        orderprofit_crm="CASE WHEN o_orderkey % 20 = 0 THEN 0 ELSE round(o_totalprice - 150000, 2) END",
        firmid="CASE WHEN o_custkey % 10 = 9 THEN 11 ELSE 1 END",
    )
    clicks = shaped(
        "clicks",
        events,
        bpid=partner("user_id"),
        datum="ts",
        send="1",
        opened="CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END",
        clicked="CASE WHEN event_type = 'click' THEN 1 ELSE 0 END",
        firmid="CASE WHEN user_id % 10 = 9 THEN 11 ELSE 1 END",
    )
    versions = customers.withColumn("version", F.expr("explode(IF(bpid % 29 = 3, array(1, 2, 3), array(1, 2)))"))
    permissions = shaped(
        "permission_hist",
        versions,
        bpid="bpid",
        accountDate="accountDate",
        push_perm="(bpid - 1 + version) % 2",
        nl_perm="CASE WHEN (bpid - 1 + version) % 3 = 0 THEN 0 ELSE 1 END",
        valid_from="CASE version WHEN 1 THEN accountDate ELSE DATE'1999-07-01' END",
        valid_to="CASE version WHEN 1 THEN DATE'1999-07-01' ELSE DATE'9999-12-31' END",
    )
    session = shaped(
        "session",
        events,
        ktnr_glob=partner("user_id"),
        wkorbid=SESSION_ID,
        mandant_id="CASE WHEN event_id % 11 = 0 THEN 32 ELSE 2 END",
        partition_date="ts",
        session_length_sek="round(value)",
        page_visits="event_id % 7",
        page_visits_ads="event_id % 3",
        device="event_id % 3",
        shopapi_client_type="CAST(event_id % 4 AS STRING)",
        kauf_bool="CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END",
        wkorb_fill_bool="CASE WHEN event_type IN ('purchase', 'click') THEN 1 ELSE 0 END",
        session_click="CASE WHEN event_type = 'error' THEN 0 ELSE 1 END",
        testkunde="CASE WHEN user_id % 50 = 0 THEN 1 ELSE 0 END",
    )
    session_hist = shaped(
        "session_hist",
        events.withColumn("n", F.expr("explode(CASE WHEN event_id % 17 = 5 THEN array() WHEN event_id % 19 = 6 THEN array(1, 2) ELSE array(1) END)")),
        ktnr=partner("user_id"),
        wkorbid=SESSION_ID,
        mandant_id="CASE WHEN event_id % 11 = 0 THEN 32 ELSE 2 END",
        gilt_von="ts",
        gilt_bis="CASE WHEN event_id % 13 = 0 THEN DATE'2024-01-30' ELSE DATE'9999-12-31' END",
    )
    views = events.withColumn("n", F.explode(F.expr("sequence(1, CAST(1 + event_id % 3 AS INT))")))
    styleview = shaped(
        "styleview",
        views,
        wkorbid=SESSION_ID,
        style_id="110000 + (event_id * 7919 + n * 104729) % 780000",
        mandant_id="CASE WHEN event_id % 11 = 0 THEN 32 ELSE 2 END",
        partition_date="ts",
    )
    return Sources(
        positions=positions,
        customer_overview=customers,
        address_overview=customers.select(
            "bpid", "accountDate", F.expr("explode(IF(bpid % 23 = 5, array(1, 2), array(1)))").alias("n")
        ).drop("n"),
        partner_exclusion=exclusions,
        order_profit=profit,
        clicks=clicks,
        permission_hist=permissions,
        session=session,
        session_hist=session_hist,
        styleview=styleview,
    )
