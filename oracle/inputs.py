"""The source tables as common table expressions over the sample tables."""

from __future__ import annotations



def _partner(key: str) -> str:
    return f"CASE WHEN {key} IN (57, 45) THEN 0 ELSE {key} + 1 END"


_SESSION = "CASE WHEN event_id % 31 = 0 THEN 0 WHEN event_id % 37 = 0 THEN event_id ELSE event_id + 1 END"

INPUTS = {
    "customer_overview": f"""
        SELECT {_partner('c_custkey')} AS bpid, CASE WHEN c_custkey % 97 <> 96 THEN opened END AS accountDate,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Z002'
                    WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Z019' ELSE 'Z001' END AS bptypeid,
               DATE '1940-01-01' + CAST((c_custkey * 101) % 25000 AS INTEGER) AS birthdate,
               c_nationkey % 3 AS salutationid
        FROM (
            SELECT *, DATE '1995-01-01' + CAST((c_custkey * 37) % 2400 AS INTEGER) AS opened FROM customer
            UNION ALL
            SELECT *, DATE '1995-01-01' + CAST((c_custkey * 37) % 2400 AS INTEGER) + 200 FROM customer
            WHERE c_custkey % 190 = 7 AND c_custkey % 97 <> 96
        )""",
    "address_overview": """
        SELECT bpid, accountDate FROM customer_overview
        UNION ALL SELECT bpid, accountDate FROM customer_overview WHERE bpid % 23 = 5""",
    "positions": f"""
        SELECT c.bpid, c.accountDate, CAST(o_orderdate AS DATE) AS orderdate,
               CAST(o_orderdate AS DATE) + 7 * l_linenumber AS reportingdate,
               rectype, l_orderkey AS orderid, CAST(l_quantity AS DECIMAL(18,2)) AS qty,
               CAST(CASE WHEN rectype = 1 AND l_returnflag = 'A' THEN -1 ELSE 1 END * l_extendedprice
                    AS DECIMAL(18,2)) AS vk,
               [20, 60, 10, NULL][l_suppkey % 4 + 1] AS catalogtypeid,
               CASE WHEN o_orderkey % 9 < 7 THEN ['I', 'i', 'T', 't', 'S', 's', NULL][o_orderkey % 9 + 1]
                    ELSE o_orderpriority END AS channel,
               CASE WHEN l_partkey % 41 = 0 THEN '4' ELSE CAST(100 + (l_partkey * 7) % 800 AS VARCHAR) END AS code,
               CASE WHEN p_size >= 46 THEN 'XL' ELSE CAST(p_size AS VARCHAR) END AS size
        FROM lineitem
        JOIN orders ON o_orderkey = l_orderkey
        JOIN part ON p_partkey = l_partkey
        JOIN customer_overview c ON c.bpid = {_partner('o_custkey')}
        JOIN (VALUES (1), (3), (5), (6), (91), (701)) AS kinds(rectype)
          ON (rectype = 1 AND o_orderstatus <> 'F')
          OR (rectype = 3 AND l_returnflag = 'A') OR (rectype = 5 AND l_returnflag <> 'A')
          OR (rectype = 6 AND l_returnflag = 'R') OR (rectype = 91 AND l_returnflag = 'N')
          OR (rectype = 701 AND o_orderpriority = '5-LOW' AND l_linenumber = 1)""",
    "partner_exclusion": f"""
        SELECT {_partner('c_custkey')} AS bpid, c_custkey % 53 AS exclusioncd,
               CASE WHEN c_custkey % 7 = 6 THEN 0 ELSE 1 END AS decisionfg,
               TIMESTAMP '1996-01-01 00:00:00' AS validfrom,
               CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2001-08-01 00:00:00'
                    ELSE TIMESTAMP '2099-12-31 00:00:00' END AS validto
        FROM customer""",
    "order_profit": f"""
        SELECT {_partner('o_custkey')} AS bpid, CAST(o_orderdate AS DATE) AS reportingdate, o_orderkey AS orderid,
               CAST(CASE WHEN o_orderkey % 20 = 0 THEN 0 ELSE round(o_totalprice - 150000, 2) END
                    AS DECIMAL(18,2)) AS profit,
               CASE WHEN o_custkey % 10 = 9 THEN 11 ELSE 1 END AS firmid
        FROM orders""",
    "clicks": f"""
        SELECT {_partner('user_id')} AS bpid, CAST(ts AS DATE) AS datum, 1 AS send,
               CAST(event_type IN ('view', 'click') AS INTEGER) AS opened,
               CAST(event_type = 'click' AS INTEGER) AS clicked,
               CASE WHEN user_id % 10 = 9 THEN 11 ELSE 1 END AS firmid
        FROM events""",
    "permission_hist": """
        SELECT bpid, accountDate, CAST(bpid % 2 AS INTEGER) AS push_perm,
               CAST(bpid % 3 <> 0 AS INTEGER) AS nl_perm,
               accountDate AS valid_from, DATE '1999-07-01' AS valid_to
        FROM customer_overview
        UNION ALL
        SELECT bpid, accountDate, CAST((bpid + 1) % 2 AS INTEGER), CAST((bpid + 1) % 3 <> 0 AS INTEGER),
               DATE '1999-07-01', DATE '9999-12-31'
        FROM customer_overview
        UNION ALL
        SELECT bpid, accountDate, CAST(bpid % 2 AS INTEGER), CAST((bpid + 2) % 3 <> 0 AS INTEGER),
               DATE '1999-07-01', DATE '9999-12-31'
        FROM customer_overview WHERE bpid % 29 = 3""",
    "session": f"""
        SELECT {_partner('user_id')} AS ktnr_glob, {_SESSION} AS wkorbid,
               CASE WHEN event_id % 11 = 0 THEN 32 ELSE 2 END AS mandant_id, CAST(ts AS DATE) AS day,
               CAST(round(value) AS BIGINT) AS seconds, event_id % 7 AS page_visits,
               event_id % 3 AS page_visits_ads, event_id % 3 AS device,
               CAST(event_id % 4 AS VARCHAR) AS client, event_type = 'purchase' AS bought,
               event_type IN ('purchase', 'click') AS filled, event_type <> 'error' AS clicked,
               user_id % 50 = 0 AS test_customer
        FROM events""",
    "session_hist": f"""
        SELECT {_partner('user_id')} AS ktnr, {_SESSION} AS wkorbid,
               CASE WHEN event_id % 11 = 0 THEN 32 ELSE 2 END AS mandant_id, CAST(ts AS DATE) AS gilt_von,
               CASE WHEN event_id % 13 = 0 THEN DATE '2024-01-30' ELSE DATE '9999-12-31' END AS gilt_bis
        FROM events JOIN (VALUES (1), (2)) AS copies(n)
          ON event_id % 17 <> 5 AND (n = 1 OR event_id % 19 = 6)""",
    "styleview": f"""
        SELECT {_SESSION} AS wkorbid,
               CAST(110000 + (event_id * 7919 + n * 104729) % 780000 AS VARCHAR) AS style,
               CASE WHEN event_id % 11 = 0 THEN 32 ELSE 2 END AS mandant_id, CAST(ts AS DATE) AS day
        FROM events JOIN (VALUES (1), (2), (3)) AS copies(n) ON n <= 1 + event_id % 3""",
}
