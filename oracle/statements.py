from __future__ import annotations

import re
from datetime import date, timedelta

from oracle.inputs import INPUTS

# Two-character article prefixes per category, big sizes and who can have them. Written
# out here as well, so that a wrong list in the library does not go unseen.
PREFIXES = {
    "Schuh": ("21", "25"),
    "Haka": ("15", "16", "17", "18"),
    "Kika": ("22", "23", "24", "26"),
    "Wae": ("20", "33", "35", "36", "37"),
    "Bade": ("65", "66"),
    "Sport": ("34", "67", "73"),
    "Acc": ("76",),
    "Dob": (
        "11", "13", "27", "28", "51", "52", "53", "54", "55", "57", "58", "61", "62", "63", "64", "68",
        "69", "70", "71", "72", "74", "75", "78", "81", "82", "83", "84", "85", "86", "87", "88",
    ),
}
HOME_PREFIXES = ("41", "42", "43", "45", "47", "48", "49")
BIG_SIZE_EXTRA_PREFIXES = ("20", "34", "35", "36", "37", "67", "73")
BIG_SIZE_CODES = (
    "331", "334", "335", "336", "651", "652", "653", "654", "656", "657", "658", "661", "662", "663",
    "664", "666", "667",
)
BIG_SIZES = ("48", "50", "52", "54", "56", "58", "60", "100", "105", "110", "115", "XL", "XXL", "XXXL")

# First and last day of the half years, in days before the anchor.
ANCHOR = date(2001, 8, 2)
FIRST_DAYS = (182, 365, 547, 730, 912, 1095, 1277, 1460)
LAST_DAYS = (1, 183, 366, 548, 731, 913, 1096, 1278)
WEB_ANCHOR = date(2024, 1, 31)


def _d(day: date) -> str:
    return f"DATE '{day.isoformat()}'"


def _ago(days: int) -> str:
    return _d(ANCHOR - timedelta(days=days))


HALF_YEARS = {k: (_ago(a), _ago(e)) for k, (a, e) in enumerate(zip(FIRST_DAYS, LAST_DAYS), start=1)}
COMPOSITES = {
    "S123": (HALF_YEARS[3][0], HALF_YEARS[1][1]),
    "S45": (HALF_YEARS[5][0], HALF_YEARS[4][1]),
    "S1_5": (HALF_YEARS[5][0], HALF_YEARS[1][1]),
}
WEB_PERIODS = {
    k: (_d(WEB_ANCHOR - timedelta(days=5 * k)), _d(WEB_ANCHOR - timedelta(days=5 * (k - 1) + 1)))
    for k in range(1, 7)
}
QUARTER = (_d(WEB_ANCHOR - timedelta(days=10)), _d(WEB_ANCHOR - timedelta(days=1)))
S1A, S1E = HALF_YEARS[1]
S2A, S2E = HALF_YEARS[2]
WEB_S1E = WEB_PERIODS[1][1]
HORIZON = _ago(1461)
LIFETIME = _ago(4567)
K8, K6 = range(1, 9), range(1, 7)


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _cols(*names: str) -> str:
    return ", ".join(names)


_NUMBER_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in ("bpid", "accountDate", "Age", "YearsOfRelationship", "SalutationID", "TargetGroupIndexRollOld_org", "NK3", "push_perm", "nl_perm")
    + tuple(f"AnzSorti_S{k}" for k in range(1, 7))
)

U = "CAST(round(qty) AS BIGINT)"
V = "CAST(round(vk) AS BIGINT)"
FT = "code[1:2]"


def _sum(value: str, cond: str) -> str:
    return f"CAST(sum({value}) FILTER (WHERE {cond}) AS BIGINT)"


def _orders(cond: str) -> str:
    return f"count(DISTINCT orderid) FILTER (WHERE {cond})"


def _any(letter: str) -> str:
    return f"max(CAST(rectype = 1 AND channel ILIKE '%{letter}%' AS INTEGER))"


ONLINE, CATALOG = "catalogtypeid IN (20, 60)", "catalogtypeid NOT IN (20, 60)"
KPIS = {
    "Nabs_ges": _sum(U, "rectype = 91"),
    "Nums_ges": _sum(V, "rectype = 91"),
    "StornoMenge_ges": _sum(U, "rectype = 3"),
    "StornoWert_ges": _sum(V, "rectype = 3"),
    "Nabs_online": _sum(U, f"rectype = 91 AND {ONLINE}"),
    "Nums_online": _sum(V, f"rectype = 91 AND {ONLINE}"),
    "Nabs_katbez": _sum(U, f"rectype = 91 AND {CATALOG}"),
    "Nums_katbez": _sum(V, f"rectype = 91 AND {CATALOG}"),
    "Orders_katbez": _orders(f"rectype = 1 AND {CATALOG}"),
    "telbweg": f"coalesce({_any('t')}, 0)",
    "brabs_ges": _sum(U, "rectype = 5"),
    "brums_ges": _sum(V, "rectype = 5"),
    "Retwert": _sum(V, "rectype = 6"),
    "RetMenge": _sum(U, "rectype = 6"),
    "NF_ges": _sum(V, "rectype = 1"),
    "NFMenge_ges": _sum(U, "rectype = 1"),
    "Orders_ges": _orders("rectype = 1"),
    "Orders_OLSArt": _orders(f"rectype = 1 AND {ONLINE}"),
    "onlbweg": f"coalesce({_any('i')}, 0)",
    "TexBM_ges": _sum(U, "rectype = 1 AND code LIKE '4%'"),
    **{
        f"{name}BM_ges": (
            f"sum(qty) FILTER (WHERE rectype = 1 AND {FT} IN {_list(prefixes)})"
            if name in ("Bade", "Sport", "Acc")
            else _sum(U, f"rectype = 1 AND {FT} IN {_list(prefixes)}")
        )
        for name, prefixes in PREFIXES.items()
    },
    "RiesigBM_ges": _sum(
        U,
        f"rectype = 1 AND size IN {_list(BIG_SIZES)} AND ({FT} IN {_list(PREFIXES['Dob'])} "
        f"OR {FT} IN {_list(BIG_SIZE_EXTRA_PREFIXES)} OR code IN {_list(BIG_SIZE_CODES)})",
    ),
    "Nutzung_VKB": _orders("rectype = 701"),
    "Umstand_BM": _sum(U, "rectype = 1 AND code LIKE '53%'"),
}
SORTS = ("Tex", *PREFIXES)
LIFETIME_KPIS = {
    "LifeTimeOrders": _orders("rectype = 1"),
    "LifetimeGrossSalesAmt": _sum(V, "rectype = 5"),
    "LifetimeGrossSalesQty": _sum(U, "rectype = 5"),
    "LifetimeReturnAmt": _sum(U, "rectype = 6"),
    "LifetimeReturnQty": _sum(V, "rectype = 6"),
    "LifetimeNetSalesAmt": _sum(V, "rectype = 91"),
    "LifetimeNetSalesQty": _sum(U, "rectype = 91"),
    "LifetimeOrdersOnline": _orders("rectype = 1 AND upper(channel) = 'I'"),
    "LifetimeOrdersOffline": _orders("rectype = 1 AND upper(channel) IN ('T', 'S')"),
}
WEB_KPIS = {
    "avg_session_length": "avg(seconds)",
    "pagevisits": "CAST(sum(page_visits) AS BIGINT)",
    "pagevisits_ads": "CAST(sum(page_visits_ads) AS BIGINT)",
    "device_unique": "count(DISTINCT device)",
    "Sessions": "count(DISTINCT wkorbid)",
    "KVB": "count(DISTINCT wkorbid) FILTER (WHERE NOT bought AND page_visits_ads > 0)",
    "WKA": "count(DISTINCT wkorbid) FILTER (WHERE NOT bought AND filled)",
    "desktopAnz": "nullif(count(*) FILTER (WHERE device = 0), 0)",
    "mobileBrowser": "nullif(count(*) FILTER (WHERE device = 1 AND client = '1'), 0)",
    "mobileApp": "nullif(count(*) FILTER (WHERE device = 1 AND client = '3'), 0)",
    "tablet": "nullif(count(*) FILTER (WHERE device = 2), 0)",
}
STYLE_LISTS = {
    "dob": PREFIXES["Dob"],
    "wae": PREFIXES["Wae"],
    "haka": PREFIXES["Haka"],
    "kika": PREFIXES["Kika"],
    "wohnen": HOME_PREFIXES,
    "schuhe": PREFIXES["Schuh"],
    "bade": PREFIXES["Bade"],
    "sport": PREFIXES["Sport"],
    "acc": PREFIXES["Acc"],
}


def _aliased(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


def _block(k: int, names=KPIS) -> str:
    lo, hi = HALF_YEARS[k]
    grace = 0 if k == 1 else 35
    return f"""SELECT bpid, accountDate, {_aliased({n: KPIS[n] for n in names})} FROM positions
        WHERE orderdate BETWEEN {lo} AND {hi} AND reportingdate BETWEEN {lo} AND {hi} + {grace}
        GROUP BY bpid, accountDate"""


def _demand_in(k: int) -> str:
    lo, hi = HALF_YEARS[k]
    return f"sum(vk) FILTER (WHERE reportingdate BETWEEN {lo} AND {hi})"


def _by_period(column: str, value: str, periods: dict, prefix: str, cast: bool) -> dict[str, str]:
    out = {}
    for k, (lo, hi) in periods.items():
        total = f"sum({value}) FILTER (WHERE {column} BETWEEN {lo} AND {hi})"
        out[f"{prefix}_S{k}"] = f"CAST({total} AS BIGINT)" if cast else total
    return out


def _pos(k: int) -> str:
    return f"coalesce(bbwS{k}, 0) > 0"


# First half year with demand, 9 for none.
_FIRST = "CASE " + " ".join(f"WHEN {_pos(k)} THEN {k}" for k in K8) + " ELSE 9 END"
_SEGMENT = f"""CASE WHEN accountDate > {S1A} THEN 2
    WHEN {_FIRST} <= 2 THEN {_FIRST} + 2
    WHEN accountDate > {S2A} THEN NULL
    WHEN {_FIRST} = 3 THEN 5 ELSE 6 END"""
_DETAIL = f"CASE WHEN accountDate <= {S2A} AND {_FIRST} >= 4 THEN {_FIRST} + 59 END"
_ROLLUP = "CASE WHEN TargetGroupIndexRollOld_org <= 65 THEN 345 WHEN TargetGroupIndexRollOld_org <= 68 THEN 678 END"
_NK3 = f"CASE WHEN accountDate BETWEEN {S2A} AND {S2E} AND {_pos(2)} THEN 1 ELSE 0 END"
_AGE = f"CAST(round(date_diff('day', birthdate, {_d(ANCHOR)}) / 365) AS BIGINT)"
_TENURE = f"CAST(round(date_diff('day', accountDate, {S1E}) / 365) AS BIGINT)"

ACTIVE_EXCLUSION = f"""SELECT bpid FROM partner_exclusion WHERE exclusioncd IN (2, 4) AND decisionfg = 1
    AND CAST(validfrom AS DATE) <= {S1E} AND CAST(validto AS DATE) > {S1E}"""


def _order_tests(periods: dict[str, tuple[str, str]]) -> dict[str, str]:
    out = {}
    for name, (lo, hi) in periods.items():
        inside = f"reportingdate BETWEEN {lo} AND {hi}"
        out[f"Orders_{name}"] = f"count(DISTINCT orderid) FILTER (WHERE {inside})"
        out[f"OrdersWithProfit_{name}"] = f"count(DISTINCT orderid) FILTER (WHERE {inside} AND profit > 0)"
    return out


RATED = {f"S{k}": HALF_YEARS[k] for k in range(1, 6)} | COMPOSITES
PROFIT_ROWS = f"SELECT * FROM order_profit WHERE firmid = 1 AND profit <> 0 AND reportingdate >= {_ago(1459)}"


def _rate(name: str) -> str:
    o, p = f"Orders_{name}", f"OrdersWithProfit_{name}"
    return f"{o}, {p}, round(CASE WHEN {o} > 0 THEN {p} / {o} ELSE 0 END, 3) AS PositiveOrderRate_{name}"


def _web_block(k: int, names=WEB_KPIS) -> str:
    lo, hi = WEB_PERIODS[k]
    return f"""SELECT s.ktnr_glob AS bpid, {_aliased({n: WEB_KPIS[n] for n in names})}
        FROM (SELECT * FROM session WHERE mandant_id = 2 AND clicked AND NOT test_customer
              AND day BETWEEN {lo} AND {hi}) s
        JOIN (SELECT ktnr AS ktnr_glob, wkorbid FROM session_hist WHERE mandant_id = 2
              AND gilt_von <= {WEB_S1E} AND gilt_bis > {WEB_S1E}) h USING (ktnr_glob, wkorbid)
        GROUP BY s.ktnr_glob"""


def _suffixed(alias: str, names, k: int) -> str:
    return ", ".join(f"{alias}.{n} AS {n}_S{k}" for n in names)


def _rates(a: str) -> str:
    def rate(name, part, other):
        total = f"({a}.{part} + {a}.{other})"
        return f"CASE WHEN {total} > 0 THEN {a}.{part} / {total} END AS {name}"

    return rate("RSQ", "RetMenge", "Nabs_ges") + ", " + rate("RWQ", "Retwert", "Nums_ges")


def _breadth(a: str) -> str:
    return " + ".join(f"coalesce(CAST({a}.{s}BM_ges > 0 AS INTEGER), 0)" for s in SORTS)


def _age_mask(k: int, expr: str) -> str:
    return f"CASE WHEN a.accountDate < {HALF_YEARS[k][1]} THEN {expr} END"


# Measures of one half year that reach the output.
OUTPUT_KPIS = (
    "Nabs_ges", "Nums_ges", "Orders_katbez", "telbweg", "brabs_ges", "brums_ges", "Retwert", "RetMenge", "RSQ",
    "RWQ", "NF_ges", "NFMenge_ges", "Orders_ges", "Orders_OLSArt", "onlbweg", "TexBM_ges", "SchuhBM_ges",
    "HakaBM_ges", "KikaBM_ges", "WaeBM_ges", "DobBM_ges", "RiesigBM_ges", "Nutzung_VKB", "Umstand_BM",
)

# Every named relation; a statement takes those it refers to, in this order.
RELATIONS = {
    **INPUTS,
    "customers": "SELECT * FROM customer_overview WHERE bptypeid IN ('Z001', 'Z019') AND accountDate IS NOT NULL",
    "demand": f"""SELECT bpid, accountDate, {_aliased({f'bbwS{k}': _demand_in(k) for k in K8})} FROM positions
        WHERE rectype = 1 AND reportingdate BETWEEN {HALF_YEARS[8][0]} AND {S1E} GROUP BY ALL""",
    "recent": f"""SELECT bpid, accountDate, sum(vk) AS nf FROM positions
        WHERE rectype = 1 AND accountDate <= {HORIZON} AND reportingdate >= {HORIZON} GROUP BY ALL""",
    "inactive": f"""SELECT c.bpid, c.accountDate FROM customer_overview c
        LEFT JOIN recent r ON r.bpid = c.bpid AND r.accountDate = c.accountDate
        WHERE c.accountDate <= {HORIZON} AND coalesce(r.nf, 0) = 0""",
    "segmented": f"""SELECT c.bpid, c.accountDate, {_AGE} AS Age, {_TENURE} AS YearsOfRelationship,
        salutationid AS SalutationID, {_SEGMENT} AS TargetGroupIndexRoll,
        {_DETAIL} AS TargetGroupIndexRollOld_org, {_NK3} AS NK3
        FROM customers c LEFT JOIN demand USING (bpid, accountDate)""",
    "people": f"""SELECT s.* FROM segmented s
        LEFT JOIN address_overview ad ON ad.bpid = s.bpid AND ad.accountDate = s.accountDate
        WHERE NOT EXISTS (SELECT 1 FROM inactive i WHERE i.bpid = s.bpid AND i.accountDate = s.accountDate
                          AND i.bpid <> 0)
          AND NOT EXISTS (SELECT 1 FROM ({ACTIVE_EXCLUSION}) e WHERE e.bpid = s.bpid AND e.bpid <> 0)""",
    **{f"pos{k}": _block(k) for k in K8},
    "lifetime": f"""SELECT bpid, accountDate, {_aliased(LIFETIME_KPIS)} FROM positions
        WHERE orderdate BETWEEN {LIFETIME} AND {S1E} AND reportingdate BETWEEN {LIFETIME} AND {S1E} GROUP BY ALL""",
    "funnel": f"""SELECT bpid, {_aliased({
        name: sql
        for step in ('send', 'clicked', 'opened')
        for name, sql in _by_period('datum', step, WEB_PERIODS, step, True).items()
    })} FROM clicks WHERE firmid = 1 AND datum BETWEEN {WEB_PERIODS[6][0]} AND {WEB_S1E} GROUP BY bpid""",
    "permission": f"""SELECT bpid, accountDate, push_perm, nl_perm FROM permission_hist
        WHERE valid_from <= {S1E} AND valid_to > {S1E}""",
    "profit": f"""SELECT bpid, {_aliased(_by_period(
        'reportingdate', 'profit', {k: HALF_YEARS[k] for k in K6}, 'orderprofit', False))}
        FROM order_profit WHERE firmid = 1 AND reportingdate >= {HALF_YEARS[6][0]} GROUP BY bpid""",
    **{f"sort{k}": f"SELECT bpid, {_breadth(f'pos{k}')} AS n FROM pos{k}" for k in K6},
    "activity": f"""SELECT a.bpid, a.accountDate,
        {' + '.join(f'CASE WHEN pos{k}.Nums_ges > 0 THEN {2 ** (6 - k)} ELSE 0 END' for k in range(1, 6))} AS mask,
        {' + '.join(f'CASE WHEN pos{k}.Nums_online > 0 THEN {2 ** (6 - k)} ELSE 0 END' for k in range(1, 6))} AS online
        FROM people a {' '.join(
            f'LEFT JOIN pos{k} ON pos{k}.bpid = a.bpid AND pos{k}.accountDate = a.accountDate' for k in range(1, 6)
        )}""",
    **{f"rated{k}": f"SELECT *, {_rates(f'pos{k}')} FROM pos{k}" for k in K8},
    "transactions": f"""SELECT a.bpid, a.accountDate, a.Age,
        {', '.join(
            f'{_age_mask(k, f"rated{k}.{n}")} AS {n}_S{k}' for k in K8 for n in OUTPUT_KPIS
        )},
        {', '.join(
            f'{_age_mask(k, f"{n}_S{k}")} AS {n}_S{k}' for k in K6 for n in ('send', 'clicked', 'opened')
        )},
        {', '.join(f'{_age_mask(k, f"orderprofit_S{k}")} AS orderprofit_S{k}' for k in range(1, 5))},
        {_cols(*LIFETIME_KPIS)}, push_perm, nl_perm,
        {', '.join(f'{_age_mask(k, f"coalesce(sort{k}.n, 0)")} AS AnzSorti_S{k}' for k in K6)},
        coalesce(activity.mask, 0) AS AktivKennzeichen, coalesce(activity.online, 0) AS AktivOLKennzeichen
        FROM people a
        {' '.join(
            f'LEFT JOIN rated{k} ON rated{k}.bpid = a.bpid AND rated{k}.accountDate = a.accountDate' for k in K8
        )}
        LEFT JOIN lifetime ON lifetime.bpid = a.bpid AND lifetime.accountDate = a.accountDate
        LEFT JOIN funnel ON funnel.bpid = a.bpid
        LEFT JOIN profit ON profit.bpid = a.bpid
        LEFT JOIN permission ON permission.bpid = a.bpid
        {' '.join(f'LEFT JOIN sort{k} ON sort{k}.bpid = a.bpid' for k in K6)}
        LEFT JOIN activity ON activity.bpid = a.bpid AND activity.accountDate = a.accountDate""",
    **{f"web{k}": _web_block(k) for k in K6},
    "style_counts": f"""SELECT wkorbid, style[1:2] AS ft, count(style) AS n FROM styleview
        WHERE mandant_id = 2 AND day BETWEEN {QUARTER[0]} AND {QUARTER[1]} GROUP BY ALL""",
    "styles": f"""SELECT s.ktnr_glob AS bpid, count(DISTINCT v.ft) AS AnzFT_Q1,
        CAST(sum(coalesce(v.n, 0)) AS BIGINT) AS AnzStyles_Q1,
        {', '.join(
            f'CAST(sum(CASE WHEN v.ft IN {_list(prefixes)} THEN v.n ELSE 0 END) AS BIGINT) AS {name}_Styles_Q1'
            for name, prefixes in STYLE_LISTS.items()
        )}
        FROM session s
        JOIN session_hist h ON h.wkorbid = s.wkorbid
        LEFT JOIN style_counts v ON v.wkorbid = s.wkorbid AND v.wkorbid > 0
        WHERE s.mandant_id = 2 AND h.mandant_id = 2 AND s.clicked AND NOT s.test_customer
          AND s.day BETWEEN {QUARTER[0]} AND {QUARTER[1]}
          AND h.gilt_von <= {QUARTER[1]} AND h.gilt_bis >= {QUARTER[1]}
        GROUP BY s.ktnr_glob""",
    "webshop": f"""SELECT a.bpid, a.accountDate,
        {', '.join(_suffixed(f'web{k}', WEB_KPIS, k) for k in K6)}, AnzFT_Q1, AnzStyles_Q1, dob_Styles_Q1
        FROM people a {' '.join(f'LEFT JOIN web{k} ON web{k}.bpid = a.bpid' for k in K6)}
        LEFT JOIN styles ON styles.bpid = a.bpid""",
}


def _select(body: str, given: frozenset[str] = frozenset()) -> str:
    """``body`` preceded by the relations it needs, directly or through others, but those ``given`` as tables."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in RELATIONS:
            if name not in needed and name not in given and re.search(rf"(?:FROM|JOIN) {name}\b", sql):
                needed.add(name)
                visit(RELATIONS[name])

    visit(body)
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in RELATIONS.items() if name in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


def _long(*names: str) -> str:
    parts = [f"SELECT bpid, accountDate, 'S{k}' AS period, {_cols(*names)} FROM ({_block(k, names)})" for k in K8]
    return " UNION ALL ".join(parts)


def _wide(names, keys: str = "bpid, accountDate", relation: str = "pos", periods=K8) -> str:
    """Period columns for every key that occurs in any period."""
    all_keys = " UNION ".join(f"SELECT {keys} FROM {relation}{k}" for k in periods)
    on = {
        k: " AND ".join(f"{relation}{k}.{key} IS NOT DISTINCT FROM a.{key}" for key in keys.split(", "))
        for k in periods
    }
    joins = " ".join(f"LEFT JOIN {relation}{k} ON {on[k]}" for k in periods)
    columns = ", ".join(_suffixed(f"{relation}{k}", names, k) for k in periods)
    keyed = ", ".join(f"a.{key}" for key in keys.split(", "))
    return f"SELECT {keyed}, {columns} FROM ({all_keys}) a {joins}"


def _people_with(names) -> str:
    columns = ", ".join(
        f"{_age_mask(k, f'pos{k}.{n}')} AS {n}_S{k}" for k in K8 for n in names
    )
    joins = " ".join(
        f"LEFT JOIN pos{k} ON pos{k}.bpid = a.bpid AND pos{k}.accountDate = a.accountDate" for k in K8
    )
    return f"SELECT a.bpid, a.accountDate, {columns} FROM people a {joins}"


def oracle_statements(given: frozenset[str] = frozenset()) -> dict[str, str]:
    """SQL per query key, over the sample tables or over source tables ``given`` in the database."""
    placed = " UNION ALL ".join(
        f"SELECT 'S{k}' AS period, * FROM positions WHERE orderdate BETWEEN {lo} AND {hi}"
        for k, (lo, hi) in HALF_YEARS.items()
    )
    graced = " UNION ALL ".join(
        f"""SELECT 'S{k}' AS period, * FROM positions WHERE orderdate BETWEEN {lo} AND {hi}
            AND reportingdate BETWEEN {lo} AND {hi} + {0 if k == 1 else 35}"""
        for k, (lo, hi) in HALF_YEARS.items()
    )
    final_columns = f"""p.*, p.bpid AS CustomerID, {_ROLLUP} AS TargetGroupindexRollOld,
        t.* EXCLUDE (bpid, accountDate, Age), w.* EXCLUDE (bpid, accountDate)"""
    bodies = {
        "src_positions_adapter": """SELECT rectype, catalogtypeid, channel AS orderchannelcd, size AS itemsize,
            count(*) AS row_count, count(DISTINCT bpid) AS partners, sum(qty) AS qty, sum(vk) AS vk,
            min(orderdate) AS first_order, max(reportingdate) AS last_report, max(code) AS last_code
            FROM positions GROUP BY ALL""",
        "scan_date_range": f"""SELECT bpid, rectype, count(*) AS row_count, sum(vk) AS vk FROM positions
            WHERE orderdate BETWEEN {S2A} AND {S2E} AND reportingdate BETWEEN {S2A} AND {S2E} + 35 GROUP BY ALL""",
        "scan_partition_pruned": f"""SELECT day AS partition_date, count(*) AS row_count,
            CAST(sum(page_visits) AS BIGINT) AS visits FROM session
            WHERE day BETWEEN {WEB_PERIODS[2][0]} AND {WEB_PERIODS[2][1]} GROUP BY ALL""",
        "refresh_range": f"""SELECT reportingdate AS reporting_day, count(*) AS row_count, sum(vk) AS vk FROM (
            SELECT reportingdate, CAST(0 AS DECIMAL(18,2)) AS vk FROM positions
            WHERE NOT reportingdate BETWEEN {S2A} AND {S1E}
            UNION ALL SELECT reportingdate, vk FROM positions WHERE reportingdate BETWEEN {S2A} AND {S1E}
            ) GROUP BY ALL""",
        "refresh_table": f"""SELECT day AS partition_date, count(*) AS row_count,
            CAST(sum(CASE WHEN day BETWEEN {WEB_PERIODS[2][0]} AND {WEB_S1E} THEN page_visits ELSE 0 END) AS BIGINT) AS visits
            FROM session WHERE day <> {WEB_PERIODS[2][1]} GROUP BY ALL""",
        "scalar_semantics": f"""SELECT bpid, orderid, rectype, {V} AS rounded_value,
            CAST(round(vk / 2) AS BIGINT) AS rounded_half, round(CAST(qty AS DOUBLE) / 7, 3) AS rounded_ratio,
            reportingdate AS reporting_day, orderdate - 35 AS days_before, orderdate + 35 AS days_after,
            date_diff('day', orderdate, reportingdate) AS lag_days, upper(channel) AS channel, {FT} AS prefix,
            coalesce(catalogtypeid, 0) AS catalog, CAST(orderid AS VARCHAR) AS order_text,
            CASE WHEN orderid > 0 THEN bpid / orderid END AS guarded FROM positions""",
        "period_assign": f"""SELECT period, rectype, count(*) AS row_count, count(DISTINCT bpid) AS partners,
            sum(vk) AS vk FROM ({placed}) GROUP BY ALL""",
        "positions_grace_window": f"""SELECT bpid, period, count(*) AS row_count,
            max(date_diff('day', orderdate, reportingdate)) AS longest_lag, sum(qty) AS qty
            FROM ({graced}) GROUP BY ALL""",
        "agg_grouped_sum": "SELECT * FROM recent",
        "demand_by_period": "SELECT * FROM demand",
        "segment_recency": "SELECT bpid, accountDate, TargetGroupIndexRoll FROM segmented",
        "segment_recency_detail": "SELECT bpid, accountDate, TargetGroupIndexRollOld_org FROM segmented",
        "segment_rollup": f"SELECT bpid, accountDate, {_ROLLUP} AS TargetGroupindexRollOld FROM segmented",
        "flag_nk3": "SELECT bpid, accountDate, NK3 FROM segmented",
        "age_and_tenure": "SELECT bpid, accountDate, Age, YearsOfRelationship FROM segmented",
        "inactive_accounts": "SELECT * FROM inactive",
        "anti_join_inactive": """SELECT bpid, accountDate FROM customers c WHERE NOT EXISTS
            (SELECT 1 FROM inactive i WHERE i.bpid = c.bpid AND i.accountDate = c.accountDate AND i.bpid <> 0)""",
        "anti_join_exclusion": f"""SELECT bpid, accountDate FROM customers c WHERE NOT EXISTS
            (SELECT 1 FROM ({ACTIVE_EXCLUSION}) e WHERE e.bpid = c.bpid AND e.bpid <> 0)""",
        "population_base": "SELECT * FROM people",
        "join_left_composite": """SELECT a.bpid, a.accountDate, d.* EXCLUDE (bpid, accountDate) FROM people a
            LEFT JOIN demand d ON d.bpid = a.bpid AND d.accountDate = a.accountDate""",
        "join_left_single_key": """SELECT a.bpid, a.accountDate, f.* EXCLUDE (bpid) FROM people a
            LEFT JOIN funnel f ON f.bpid = a.bpid""",
        "key_uniqueness": """SELECT bpid, count(*) AS row_count FROM permission_hist
            GROUP BY bpid HAVING count(*) > 1""",
        "sum_of_rounded": f"""SELECT bpid, accountDate, rectype, CAST(sum({V}) AS BIGINT) AS sum_rounded,
            sum(vk) AS sum_exact FROM positions GROUP BY ALL""",
        "measure_net_gross_returns": _long(
            "Nabs_ges", "Nums_ges", "StornoMenge_ges", "StornoWert_ges", "brabs_ges", "brums_ges", "Retwert",
            "RetMenge", "NF_ges", "NFMenge_ges",
        ),
        "measure_catalog_split": _long(
            "Nabs_online", "Nums_online", "Nabs_katbez", "Nums_katbez", "Orders_katbez", "Orders_ges",
            "Orders_OLSArt", "Nutzung_VKB",
        ),
        "measure_channel_flags": _long("telbweg", "onlbweg"),
        "measure_categories": _long(*[f"{s}BM_ges" for s in SORTS], "Umstand_BM"),
        "measure_big_size": _long("RiesigBM_ges"),
        "position_kpis_long": _long(*KPIS),
        "position_kpis_wide": _wide(KPIS),
        "lifetime_kpis": "SELECT * FROM lifetime",
        "lifetime_store": "SELECT * FROM lifetime",
        "return_rates": _wide(("RSQ", "RWQ"), relation="rated"),
        "assortment_breadth": f"""SELECT a.bpid, a.accountDate,
            {', '.join(f'{_age_mask(k, f"coalesce(sort{k}.n, 0)")} AS AnzSorti_S{k}' for k in K6)},
            FROM people a LEFT JOIN permission ON permission.bpid = a.bpid
            {' '.join(f'LEFT JOIN sort{k} ON sort{k}.bpid = a.bpid' for k in K6)}""",
        "activity_bitmask": """SELECT bpid, accountDate, mask AS AktivKennzeichen, online AS AktivOLKennzeichen
            FROM activity""",
        "mask_by_account_age": _people_with(("NF_ges", "Orders_ges")),
        "orders_distinct_by_period": f"""SELECT bpid, {_aliased(
            _order_tests({f'S{k}': HALF_YEARS[k] for k in K8}))} FROM ({PROFIT_ROWS}) GROUP BY bpid""",
        "orders_composite_periods": f"""SELECT bpid, {_aliased(_order_tests(COMPOSITES))}
            FROM ({PROFIT_ROWS}) GROUP BY bpid""",
        "order_quotes": f"""SELECT bpid, accountDate, {', '.join(_rate(name) for name in RATED)} FROM (
            SELECT a.bpid, a.accountDate, {_aliased(_order_tests(RATED))}
            FROM people a JOIN ({PROFIT_ROWS}) o ON o.bpid = a.bpid GROUP BY a.bpid, a.accountDate)""",
        "profit_by_period": "SELECT * FROM profit",
        "newsletter_funnel": "SELECT * FROM funnel",
        "asof_permission": "SELECT * FROM permission",
        "asof_closed": f"""SELECT ktnr,
            count(*) FILTER (WHERE gilt_von <= {QUARTER[1]} AND gilt_bis >= {QUARTER[1]}) AS valid_closed,
            count(*) FILTER (WHERE gilt_von <= {QUARTER[1]} AND gilt_bis > {QUARTER[1]}) AS valid_half_open
            FROM session_hist GROUP BY ktnr""",
        "web_session_features": " UNION ALL ".join(f"SELECT *, 'S{k}' AS period FROM web{k}" for k in K6),
        "web_device_mix": _wide(
            ("device_unique", "desktopAnz", "mobileBrowser", "mobileApp", "tablet"), "bpid", "web", K6
        ),
        "web_abandonment": _wide(("Sessions", "KVB", "WKA"), "bpid", "web", K6),
        "style_interest": "SELECT * FROM styles",
        "star_except": """SELECT p.* EXCLUDE (Age, NK3), o.* EXCLUDE (bpid) FROM people p
            LEFT JOIN profit o ON o.bpid = p.bpid""",
        "segment_row_number": f"""SELECT *, row_number() OVER (
            PARTITION BY TargetGroupIndexRoll, TargetGroupindexRollOld ORDER BY bpid NULLS FIRST, accountDate NULLS FIRST) AS rownumber
            FROM (SELECT bpid, accountDate, TargetGroupIndexRoll, {_ROLLUP} AS TargetGroupindexRollOld FROM people)""",
        "datamart_transactions": "SELECT * FROM transactions",
        "datamart_webshop": "SELECT * FROM webshop",
        "datamart_full": f"""SELECT *, row_number() OVER (
            PARTITION BY TargetGroupIndexRoll, TargetGroupindexRollOld ORDER BY {_NUMBER_ORDER}) AS rownumber
            FROM (SELECT {final_columns} FROM people p
                  LEFT JOIN transactions t ON t.bpid = p.bpid AND t.accountDate = p.accountDate
                  LEFT JOIN webshop w ON w.bpid = p.bpid AND w.accountDate = p.accountDate)""",
    }
    return {name: _select(body, given) for name, body in bodies.items()}
