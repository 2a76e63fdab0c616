"""Small random sources full of edge cases, as Spark DataFrames and as DuckDB tables."""

from __future__ import annotations

import random
from datetime import date, datetime, time, timedelta
from decimal import Decimal

import duckdb

from rollwise.sources import Sources
from rollwise.sources.tables import schema_of

ANCHOR = date(2001, 8, 2)
WEB_ANCHOR = date(2024, 1, 31)
# Days before the anchor on which periods, grace ranges and horizons begin or end.
EDGES = [0, 1, 2, 35, 148, 147, 182, 183, 184, 218, 365, 366, 367, 547, 548, 730, 912, 1095, 1277, 1459, 1460, 1461, 1462, 4567, 4568]


def _day(rng, far=2200):
    days = rng.choice(EDGES) if rng.random() < 0.3 else rng.randrange(-20, far)
    return ANCHOR - timedelta(days=days)


def _at(rng, day):
    return datetime.combine(day, rng.choice([time(0), time(12, 30), time(23, 59, 59)]))


def _web_day(rng):
    return WEB_ANCHOR - timedelta(days=rng.randrange(-1, 33))


def random_rows(seed: int) -> dict[str, list[tuple]]:
    """Partners with several accounts and addresses, key 0, NULLs, .5 values and one hot key each."""
    rng = random.Random(seed)
    hot = 7

    def partner():
        return None if rng.random() < 0.03 else hot if rng.random() < 0.33 else rng.randrange(0, 16)

    accounts = [(b, _day(rng)) for b in range(16)] + [(hot, _day(rng)), (3, _day(rng)), (0, ANCHOR - timedelta(days=1500))]
    accounts += [(20 + i, ANCHOR - timedelta(days=e)) for i, e in enumerate(EDGES)]
    customers = [
        (b, a if rng.random() < 0.95 else None, rng.choice(["Z001", "Z001", "Z019", "Z002", None]),
         date(1940, 1, 1) + timedelta(days=rng.randrange(25000)), rng.choice([1, 2, None]))
        for b, a in accounts
    ]
    customers += [(None, date(2000, 1, 1), "Z001", date(1980, 1, 1), 1)] * 2
    addresses = [(b, a) for b, a in accounts if rng.random() < 0.8] + [accounts[3], accounts[3], accounts[12]]
    owned = {None: [None, date(2000, 1, 1)]}
    for b, a in accounts:
        owned.setdefault(b, []).append(a)
    positions = []
    for _ in range(900):
        b = rng.randrange(20, 20 + len(EDGES)) if rng.random() < 0.3 else partner()
        ordered = _day(rng)
        lag = rng.choice([0, 1, 34, 35, 36, rng.randrange(0, 60)])
        positions.append(
            (b, rng.choice(owned[b]), _at(rng, ordered), _at(rng, ordered + timedelta(days=lag)),
             rng.choice([1, 1, 1, 3, 5, 6, 6, 91, 91, 91, 701, 2]),
             rng.choice([None, *range(40)]), Decimal(rng.choice(["1", "2.5", "-2.5", "3.5", "0.49", "1"])),
             Decimal(rng.choice(["10", "-10", "2.5", "-2.5", "99.99", "10"])), rng.choice([20, 60, 10, None]),
             rng.choice(["I", "T", "s", "phone", "online", None]),
             rng.choice([None, "4", "331", "667", *[str(rng.randrange(100, 900)) for _ in range(6)]]),
             rng.choice(["48", "XL", "50", "38", None]))
        )
    # A demand that nets to zero after the horizon keeps its account inactive.
    opened, late = ANCHOR - timedelta(days=2000), datetime(2001, 1, 5)
    customers.append((60, opened, "Z001", date(1970, 1, 1), 1))
    for value in ("10", "-10"):
        positions.append((60, opened, late, late, 1, 900, Decimal(1), Decimal(value), 20, "I", "411", "48"))
    exclusions = [
        (b, rng.choice([2, 3, 4]), rng.choice([0, 1, 1]), datetime(1996, 1, 1),
         rng.choice([datetime(2001, 8, 1, 23), datetime(2001, 8, 2), datetime(2099, 12, 31)]))
        for b in [0, 2, 5, 5, 9, 21, 22]
    ]
    profit = [
        (partner(), _day(rng), rng.choice([None, *range(60)]), Decimal(rng.choice(["5", "-5", "0", "1.25"])), rng.choice([1, 1, 11]))
        for _ in range(300)
    ]
    clicks = [(partner(), _web_day(rng), 1, rng.randrange(2), rng.choice([0, 1, None]), rng.choice([1, 1, 11])) for _ in range(300)]
    permissions = []
    for b, a in accounts:
        for start, end in rng.sample([(1990, 1999), (1999, 2001), (1999, 9999), (2000, 9999)], rng.randrange(0, 3)):
            end_day = date(2001, 8, 1) if end == 2001 else date(end, 12, 31)
            permissions.append((b, a, rng.randrange(2), rng.randrange(2), date(start, 1, 1), end_day))
    sessions, history, views = [], [], []
    for i in range(300):
        b, s = partner(), rng.choice([0, None, i % 90, i % 90, i % 90])
        sessions.append(
            (b, s, rng.choice([2, 2, 2, 32]), _web_day(rng), rng.choice([None, 5, 9, 100]), rng.choice([None, 1, 4]),
             rng.randrange(3), rng.choice([0, 1, 2, 3, None]), rng.choice(["1", "3", "0", None]), rng.randrange(2),
             rng.randrange(2), rng.choice([1, 1, 0]), rng.choice([0, 0, 1]))
        )
        for _ in range(rng.choice([0, 1, 1, 2])):
            ends = rng.choice([date(2024, 1, 29), date(2024, 1, 30), date(9999, 12, 31)])
            history.append((b, s, rng.choice([2, 2, 32]), _web_day(rng), ends))
        for _ in range(rng.randrange(3)):
            views.append((s, rng.choice([None, 7, rng.randrange(100000, 900000)]), rng.choice([2, 2, 32]), _web_day(rng)))
    return {
        "positions": positions,
        "customer_overview": customers,
        "address_overview": addresses,
        "partner_exclusion": exclusions,
        "order_profit": profit,
        "clicks": clicks,
        "permission_hist": permissions,
        "session": sessions,
        "session_hist": history,
        "styleview": views,
    }


def spark_sources(spark, rows) -> Sources:
    return Sources(**{name: spark.createDataFrame(data, schema_of(name)) for name, data in rows.items()})


# The columns as the DuckDB statements name them.
_RENAMED = {
    "positions": """bpid, accountDate, CAST(orderdate AS DATE) AS orderdate, CAST(reportingdate AS DATE) AS reportingdate,
        rectype, orderid, kpivalueqty AS qty, kpivaluevk AS vk, catalogtypeid, orderchannelcd AS channel,
        promotionpurchasecd AS code, itemsize AS size""",
    "order_profit": "bpid, reportingdate, orderid, orderprofit_crm AS profit, firmid",
    "session": """ktnr_glob, wkorbid, mandant_id, partition_date AS day, session_length_sek AS seconds, page_visits,
        page_visits_ads, device, shopapi_client_type AS client, kauf_bool = 1 AS bought, wkorb_fill_bool = 1 AS filled,
        session_click = 1 AS clicked, testkunde = 1 AS test_customer""",
    "styleview": "wkorbid, CAST(style_id AS VARCHAR) AS style, mandant_id, partition_date AS day",
}
_TYPES = {"timestamp_ntz": "TIMESTAMP", "string": "VARCHAR", "int": "INTEGER"}


def duck_sources(rows) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name, data in rows.items():
        fields = schema_of(name).fields
        ddl = ", ".join(f"{f.name} {_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())}" for f in fields)
        connection.execute(f"CREATE TABLE raw_{name} ({ddl})")
        marks = ", ".join("?" * len(fields))
        connection.executemany(f"INSERT INTO raw_{name} VALUES ({marks})", data)
        connection.execute(f"CREATE VIEW {name} AS SELECT {_RENAMED.get(name, '*')} FROM raw_{name}")
    return connection
