"""Operators, period grids, sinks and plan shapes."""

from __future__ import annotations

import contextlib
import io
import math
import re
from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollwise.functions import in_days, in_days_sql, round_to_long, upper_sql, valid_at
from rollwise.operators import assign_period, duplicate_keys, number_rows, repeat_rows, salted_join, split_copies
from rollwise.params import Params, equal_periods, half_year_periods
from rollwise.plans import datamart, population, positions, store, web
from rollwise.plans.population import segment_detail_sql, segment_sql
from rollwise.sources import read_sources, refresh_partitions, refreshed, sample_params, sample_sources, scope, sinks, stage, staging, write_durable
from rollwise.queries import QUERIES
from rollwise.sources.tables import schema_of
from tests.random_sources import random_rows, spark_sources

P = Params(anchor=date(2001, 8, 2))


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


# --- parameters ----------------------------------------------------------------------------------


@given(st.dates(date(1990, 1, 1), date(2090, 1, 1)))
def test_half_years_are_adjacent(anchor):
    periods = half_year_periods(anchor)
    assert periods[0].hi == anchor - timedelta(days=1)
    assert [p.name for p in periods] == [f"S{k}" for k in range(1, 9)]
    for newer, older in zip(periods, periods[1:]):
        assert newer.lo - older.hi == timedelta(days=1)
        assert older.hi_grace - older.hi == timedelta(days=35)
    assert periods[0].hi_grace == periods[0].hi
    assert all((p.hi - p.lo).days + 1 in (182, 183) for p in periods)


def test_offsets_of_the_grid():
    first = [(P.anchor - p.lo).days for p in P.periods]
    last = [(P.anchor - p.hi).days for p in P.periods]
    assert first == [182, 365, 547, 730, 912, 1095, 1277, 1460]
    assert last == [1, 183, 366, 548, 731, 913, 1096, 1278]
    assert ((P.anchor - P.quarter.lo).days, (P.anchor - P.quarter.hi).days) == (92, 1)
    assert P.contact_periods == P.periods[:6]


def test_grid_takes_gaps(spark):
    periods = equal_periods(P.anchor, 10, 3)[::2]
    days = spark.createDataFrame([(P.anchor - timedelta(days=n),) for n in range(0, 40)], "day date")
    placed = {r.day: r.period for r in assign_period(days, "day", periods).collect()}
    for n in range(0, 40):
        expected = "S1" if 1 <= n <= 10 else "S3" if 21 <= n <= 30 else None
        assert placed.get(P.anchor - timedelta(days=n)) == expected


# --- scalars -------------------------------------------------------------------------------------


def test_rounding_is_half_away_from_zero(spark):
    values = ["2.5", "-2.5", "3.5", "0.49", "-0.5", "2.49"]
    df = spark.createDataFrame([(Decimal(v),) for v in values], "v decimal(18,2)")
    expected = [math.copysign(math.floor(abs(float(v)) + 0.5), float(v)) for v in values]
    assert [r[0] for r in df.select(round_to_long(F.col("v"))).collect()] == expected


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "timestamp"])
def test_last_day_counts_until_midnight(spark, kind):
    df = spark.createDataFrame([(datetime(2001, 8, 1, 23, 59, 59),), (datetime(2001, 8, 2),)], "t timestamp")
    df = df.select(F.col("t").cast(kind).alias("t"))
    assert df.filter(in_days(df, "t", date(2001, 8, 1), date(2001, 8, 1))).count() == 1
    assert df.filter(in_days(df, "t", lo=date(2001, 8, 2))).count() == 1


def test_as_of_end_is_open_unless_closed(spark):
    day = date(2001, 8, 1)
    rows = [(1, date(2000, 1, 1), day), (2, date(2000, 1, 1), date(2001, 8, 2)), (3, day, date(9999, 12, 31)), (4, date(2001, 8, 2), date(9999, 12, 31))]
    df = spark.createDataFrame(rows, "id int, a date, b date")
    assert {r.id for r in df.filter(valid_at(df, "a", "b", day)).collect()} == {2, 3}
    assert {r.id for r in df.filter(valid_at(df, "a", "b", day, closed=True)).collect()} == {1, 2, 3}


# --- features ------------------------------------------------------------------------------------


def test_segment_is_the_first_half_year_with_demand(spark):
    s1a, s2a = P.period(1).lo, P.period(2).lo
    demand = {k: f"bbwS{k}" for k in range(1, 9)}
    rows, expected = [], []
    for opened in (s1a + timedelta(days=1), s1a, s2a + timedelta(days=1), s2a, date(1990, 1, 1)):
        for first in range(1, 10):
            rows.append((opened, *[Decimal(-1) if k < first else Decimal(5) if k == first else None for k in demand]))
            if opened > s1a:
                expected.append((2, None))
            elif first <= 2:
                expected.append((first + 2, None))
            elif opened > s2a:
                expected.append((None, None))
            else:
                expected.append((5 if first == 3 else 6, None if first == 3 else 59 + first))
    ddl = "accountDate date, " + ", ".join(f"{c} decimal(18,2)" for c in demand.values())
    df = spark.createDataFrame(rows, ddl).selectExpr(segment_sql(P), segment_detail_sql(P))
    assert [tuple(r) for r in df.collect()] == expected


@pytest.fixture(scope="module")
def sources(spark):
    return spark_sources(spark, random_rows(3))


def test_value_ranges(sources):
    rows = datamart.datamart_transactions(sources, sample_params()).collect()
    assert rows
    for r in rows:
        assert r.AktivKennzeichen % 2 == 0 and 0 <= r.AktivKennzeichen <= 62
        assert r.AktivOLKennzeichen % 2 == 0 and 0 <= r.AktivOLKennzeichen <= 62
        for k in range(1, 7):
            breadth = r[f"AnzSorti_S{k}"]
            assert breadth is None or 0 <= breadth <= 9


def test_columns_and_numbers(sources):
    df = datamart.datamart(sources, sample_params())
    assert df.columns == datamart.datamart_columns(sample_params())
    assert len(df.columns) == 313
    groups = {}
    for r in df.select("TargetGroupIndexRoll", "TargetGroupindexRollOld", "rownumber").collect():
        groups.setdefault(r[:2], []).append(r[2])
    assert len(groups) > 3
    for numbers in groups.values():
        assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_everything_follows_from_one_read_of_the_positions(sources):
    params = sample_params()
    orders = positions.order_facts(sources.positions, params)
    assert plan_of(orders.groupBy("bpid").count()).split("== Physical Plan ==")[-1].count("Scan") == 1
    staged = stage(orders, "orders")
    for whole, of_orders in (
        (positions.position_kpis_long(sources.positions, params), positions.period_kpis_of(staged)),
        (positions.lifetime_kpis(sources.positions, params), positions.lifetime_kpis_of(staged)),
        (population.population(sources, params), population.population(sources, params, population.demand_profile_of(staged, params))),
    ):
        assert sorted(map(str, whole.collect())) == sorted(map(str, of_orders.select(whole.columns).collect()))


def test_outputs_read_the_positions_once(spark, sources, tmp_path):
    """Counted by the columns of each scan of the positions' folder in the plans of a whole run."""
    for name, df in vars(sources).items():
        df.write.parquet(str(tmp_path / name))
    stored = read_sources(spark, folder=str(tmp_path))
    params, seen = sample_params(), []

    def keep(df, name, *_, **__):
        seen.append(plan_of(df))
        return stage(df, name)

    inputs = datamart.prepare(stored, params, keep)
    seen += [plan_of(df) for df in (datamart.transactions(inputs), datamart.full(inputs))]
    place = f"{tmp_path.name}/positions"
    assert sum(p.split("== Physical Plan ==")[-1].count(place) for p in seen) == 1


def test_accounts_in_buckets_are_not_exchanged_again(spark, sources):
    params = sample_params()
    exchanges = {}
    for bucketed in (True, False):
        with staging(spark) as keep:
            inputs = datamart.prepare(sources, params, keep if bucketed else lambda df, name, *_, **__: keep(df, name))
            before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            try:
                plan = plan_of(datamart.with_features(inputs.people.withColumns({n: F.lit(0) for n in datamart.BREADTH}), inputs.accounts, inputs.partners, params))
            finally:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
            exchanges[bucketed] = plan.split("== Physical Plan ==")[-1].count("Exchange hashpartitioning")
    assert exchanges == {True: 3, False: 4}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("staged_")]


def test_store_gives_lifetime_values_of_any_day(spark, sources, tmp_path):
    """A new day is read alone, of the positions; the result is that of a full run."""
    placed = sources.positions.withColumn("month", F.trunc("reportingdate", "month"))
    placed.write.partitionBy("month").parquet(str(tmp_path / "positions"))
    given = spark.read.parquet(str(tmp_path / "positions"))
    today = date(2001, 7, 20)
    known = given.filter(in_days(given, "reportingdate", hi=today - timedelta(days=1)))
    store.create_store(known, "lifetime_store", str(tmp_path / "store"))
    read = []
    real = store.refresh_partitions
    try:
        store.refresh_partitions = lambda source, *args: (read.append(source.inputFiles()), read.append(plan_of(source)), real(source, *args))
        store.refresh_store(given.filter((F.col("month") >= F.lit(date(2001, 7, 1))) & in_days(given, "reportingdate", hi=today)), "lifetime_store", today, today)
    finally:
        store.refresh_partitions = real
    assert "reportingdate" in read[1].split("PushedFilters")[1][:400]
    for anchor in (today + timedelta(days=1), today - timedelta(days=200)):
        params = Params(anchor=anchor)
        upto = given.filter(in_days(given, "reportingdate", hi=today))
        want = positions.lifetime_kpis(upto, params)
        assert sorted(map(str, store.lifetime_kpis_from(spark.table("lifetime_store"), params).select(want.columns).collect())) == sorted(map(str, want.collect()))
    plan = plan_of(store.lifetime_kpis_from(spark.table("lifetime_store"), Params(anchor=today + timedelta(days=1))))
    assert "reporting_month" in plan.split("PartitionFilters")[1][:300]
    spark.sql("DROP TABLE lifetime_store")


def test_style_interest_splits_hot_sessions(sources):
    args = (sources.session, sources.session_hist, sources.styleview, sample_params())
    assert web.style_interest(*args, hot_share=0.001).exceptAll(web.style_interest(*args)).isEmpty()
    assert web.style_interest(*args).exceptAll(web.style_interest(*args, hot_share=0.001)).isEmpty()


def test_distinct_orders_need_no_expand(sources):
    for df in (
        positions.position_kpis_wide(sources.positions, P),
        positions.lifetime_kpis(sources.positions, P),
        web.web_features_long(sources.session, sources.session_hist, P),
    ):
        assert "Expand" not in plan_of(df)


# --- operators -----------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_join(spark, how):
    left = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k"), "id")
    right = spark.range(60).select((F.col("id") % 30).alias("k"), F.col("id").alias("r"))
    salted = salted_join(left, right, "k", F.col("id"), how, hot_share=0.05, salts=8)
    plain = left.join(right, "k", how)
    assert sorted(map(str, salted.select("k", "id", "r").collect())) == sorted(map(str, plain.select("k", "id", "r").collect()))


def test_hot_and_missing_partners_are_split(spark):
    """A third of the population has one partner and a fifth has none; each meets in several tasks."""
    hot = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 5 == 1, None).otherwise(F.col("id") % 90)
    people = spark.range(6000).select(hot.alias("bpid"), F.date_add(F.lit(date(1990, 1, 1)), (F.col("id") % 999).cast("int")).alias("accountDate"), "id", F.lit(1).cast("long").alias("_times"))
    accounts = people.filter("id % 20 < 3").select("bpid", "accountDate", *[((F.col("id") + k) % 4).alias(name) for k, name in enumerate(datamart.BREADTH)]).distinct()
    history = spark.range(200).selectExpr("id % 80 AS bpid", "DATE'1990-01-01' AS accountDate", "CAST(id % 2 AS INT) AS push_perm", "CAST(id % 3 AS INT) AS nl_perm", "DATE'1990-01-01' AS valid_from", "DATE'9999-12-31' AS valid_to")
    rows = datamart.spine(people, accounts, history, P)
    plain = people.join(datamart.permission_choices(history, P), "bpid", "left").join(datamart.breadth_choices(accounts), "bpid", "left")
    for name in datamart.BREADTH:
        plain = plain.withColumn(name, F.explode_outer(name))
    times = " * ".join(["_times", "coalesce(permission_rows, 1L)", *[f"coalesce({name}.accounts, 1L)" for name in datamart.BREADTH]])
    plain = plain.selectExpr("id", "bpid", f"{times} AS _times", "push_perm", *[f"coalesce({name}.breadth, 0) AS {name}" for name in datamart.BREADTH])
    assert rows.select(*plain.columns).exceptAll(plain).isEmpty() and plain.exceptAll(rows.select(*plain.columns)).isEmpty()
    tasks = rows.withColumn("task", F.spark_partition_id()).groupBy("bpid").agg(F.countDistinct("task").alias("tasks"), F.countDistinct("id").alias("n"))
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = {r.bpid: r.tasks for r in tasks.filter("n > 500").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(found) == {7, None} and min(found.values()) > 1


def test_period_columns_stay_in_hash_aggregation(sources):
    wide = positions.position_kpis_wide(sources.positions, sample_params())
    plan = plan_of(wide)
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and "collect_list" not in plan


def test_numbers_equal_a_window(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 2 == 0, "small").alias("g"),
        F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("o"),
        "id",
    )
    numbered = number_rows(df, ["g"], ["o", "id"], stage, out="n")
    expected = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o", "id")))
    assert sorted(map(str, numbered.collect())) == sorted(map(str, expected.select(numbered.columns).collect()))


def test_weights_number_every_copy(spark):
    df = spark.range(40).selectExpr("id % 2 AS g", "id AS o", "1L + id * id * 3 AS _times")
    numbered = number_rows(df, ["g"], ["o"], stage, out="n", weight="_times")
    copies = repeat_rows(split_copies(numbered, "n"), number="n")
    expected = repeat_rows(df).withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert copies.count() == 40 + 3 * sum(i * i for i in range(40))
    # Copies of a row are equal, so only the set of numbers per row is defined.
    assert sorted(map(tuple, copies.select("g", "o", "n").collect())) == sorted(map(tuple, expected.select("g", "o", "n").collect()))


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "bpid long")
    assert {tuple(r) for r in duplicate_keys(df, "bpid").collect()} == {(1, 2), (None, 2)}


# --- sources and sinks ---------------------------------------------------------------------------


def test_parquet_sources_prune_and_push_down(spark, sources, tmp_path):
    for name in ("positions", "session", "styleview"):
        writer = getattr(sources, name).write
        (writer if name == "positions" else writer.partitionBy("partition_date")).parquet(f"{tmp_path}/{name}")
    for name in ("customer_overview", "address_overview", "partner_exclusion", "order_profit", "clicks", "permission_hist", "session_hist"):
        getattr(sources, name).write.parquet(f"{tmp_path}/{name}")
    stored = read_sources(spark, folder=str(tmp_path))
    plan = plan_of(web.web_features_long(stored.session, stored.session_hist, sample_params()))
    assert "PartitionFilters: [isnotnull(partition_date" in plan
    plan = plan_of(positions.lifetime_kpis(stored.positions, P))
    assert "GreaterThanOrEqual(orderdate" in plan and "GreaterThanOrEqual(reportingdate" in plan
    assert "kpivaluevk" in plan and "itemsize" not in plan.split("ReadSchema")[-1]
    params = sample_params()
    want = datamart.datamart(sources, params).drop("rownumber")
    got = datamart.datamart(stored, params).drop("rownumber")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_tables_and_views_as_sources(spark, sources):
    for name in ("positions", "customer_overview", "address_overview", "partner_exclusion", "order_profit", "clicks", "permission_hist", "session", "session_hist", "styleview"):
        getattr(sources, name).createOrReplaceTempView(name)
    assert read_sources(spark).positions.schema == schema_of("positions")


def test_durable_output_is_replaced_without_a_gap(spark):
    def content():
        return sorted(r.id for r in spark.table("durable_output").collect())

    for n in (3, 2, 4):
        write_durable(spark.range(n), "durable_output")
        assert content() == list(range(n))
    before = spark.table("durable_output")
    failing = spark.range(5).withColumn("id", F.expr("IF(id = 3, raise_error('stop'), id)"))
    with pytest.raises(Exception, match="stop"):
        write_durable(failing, "durable_output")
    assert content() == [0, 1, 2, 3]
    # A query planned before the switch still ends, and only the last two contents are kept.
    write_durable(spark.range(6), "durable_output")
    assert before.count() == 4 and content() == list(range(6))
    home = Path(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:"))
    assert len(list((home / "durable_output.versions").iterdir())) == 2
    # Written from its own content, and with other columns.
    write_durable(spark.table("durable_output").filter("id > 2"), "durable_output")
    assert content() == [3, 4, 5]
    write_durable(spark.table("durable_output").selectExpr("id", "CAST(id AS STRING) AS name"), "durable_output")
    assert spark.table("durable_output").columns == ["id", "name"] and content() == [3, 4, 5]


def test_all_outputs_are_written(spark, sources):
    params = sample_params()
    spark.sql("CREATE DATABASE IF NOT EXISTS outputs")
    for _ in range(2):
        datamart.write_outputs(sources, params, "outputs")
    tables = {name: spark.table(f"outputs.{name}") for name in datamart.OUTPUTS}
    assert tables["datamart"].columns == datamart.datamart_columns(params)
    assert tables["datamart"].count() == datamart.datamart(sources, params).count()
    assert len(tables["datamart_transactions"].columns) == 236
    assert len(tables["datamart_webshop"].columns) == 71
    whole = {
        "population": QUERIES["population_base"],
        "order_quotes": QUERIES["order_quotes"],
        "datamart_transactions": QUERIES["datamart_transactions"],
        "datamart_webshop": QUERIES["datamart_webshop"],
        "datamart": QUERIES["datamart_full"],
    }
    for name, query in whole.items():
        want = query(sources, params).drop("rownumber")
        got = tables[name].select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    counts = {r.source: r["keys"] for r in spark.table("outputs.duplicate_keys").collect()}
    assert counts["permission_hist"] == QUERIES["key_uniqueness"](sources, params).count()


@pytest.fixture(params=["managed", "external"])
def refreshed_table(spark, request, tmp_path):
    """Days 1 to 10 with the value 1, as a table of either kind."""
    name = f"refreshed_{request.param}"
    writer = _days(spark, 1, range(1, 11)).write.partitionBy("day").format("parquet")
    (writer.option("path", str(tmp_path / "days")) if request.param == "external" else writer).saveAsTable(name)
    yield name
    spark.sql(f"DROP TABLE {name}")


def _days(spark, value, days):
    return spark.createDataFrame([(value, date(2001, 1, d)) for d in days], "v int, day date")


def _content(spark, table):
    rows = [(r.v, r.day.day) for r in spark.table(table).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_refresh_touches_the_range_only(spark, refreshed_table):
    """Day 5 has vanished from the source, day 11 is new, day 13 lies outside."""
    source = _days(spark, 2, [4, 6, 7, 11, 13])
    lo, hi = date(2001, 1, 4), date(2001, 1, 11)
    expected = {(1, d) for d in (1, 2, 3)} | {(2, d) for d in (4, 6, 7, 11)}
    virtual = refreshed(spark.table(refreshed_table), source, "day", lo, hi)
    assert {(r.v, r.day.day) for r in virtual.collect()} == expected
    for _ in range(2):
        refresh_partitions(source, refreshed_table, "day", lo, hi)
        assert _content(spark, refreshed_table) == expected
    # The files are gone too: nothing comes back when the partitions are looked for.
    spark.sql(f"ALTER TABLE {refreshed_table} RECOVER PARTITIONS")
    assert _content(spark, refreshed_table) == expected
    refresh_partitions(source.limit(0), refreshed_table, "day", date(2001, 1, 7), hi)
    assert _content(spark, refreshed_table) == {x for x in expected if x[1] < 7}


@pytest.mark.parametrize("step", ["ADD IF NOT EXISTS", "files", "DROP IF EXISTS"])
def test_refresh_can_be_repeated_after_a_failure(spark, refreshed_table, step, monkeypatch):
    source = _days(spark, 2, [4, 6, 11])
    lo, hi = date(2001, 1, 4), date(2001, 1, 11)
    with monkeypatch.context() as patched:
        if step == "files":
            patched.setattr(sinks, "_remove", lambda *_: (_ for _ in ()).throw(OSError("stop")))
        else:
            sql = type(spark).sql

            def failing(self, text, *args, **kwargs):
                if step in text:
                    raise OSError("stop")
                return sql(self, text, *args, **kwargs)

            patched.setattr(type(spark), "sql", failing)
        with pytest.raises(OSError, match="stop"):
            refresh_partitions(source, refreshed_table, "day", lo, hi)
    # What is there is of before or of after, and nothing outside the range has changed.
    between = _content(spark, refreshed_table)
    assert {x for x in between if x[1] < 4} == {(1, 1), (1, 2), (1, 3)} and {(2, 4), (2, 6)} <= between
    refresh_partitions(source, refreshed_table, "day", lo, hi)
    assert _content(spark, refreshed_table) == {(1, 1), (1, 2), (1, 3), (2, 4), (2, 6), (2, 11)}


def test_refresh_with_null_days_and_a_second_partition_column(spark):
    def rows(value, days):
        data = [(value, d and date(2001, 1, d), k) for d in days for k in ("a=b", "c")]
        return spark.createDataFrame(data, "v int, day date, kind string")

    rows(1, [None, *range(1, 8)]).write.partitionBy("day", "kind").format("parquet").saveAsTable("refreshed_by_two")
    source = rows(2, [None, 3, 5, 9]).filter("NOT (day = DATE'2001-01-05' AND kind = 'c')")
    untouched = {r[0]: r[1] for r in _files(spark, "refreshed_by_two") if not any(f"day=2001-01-0{d}" in r[0] for d in (3, 4, 5))}
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    expected = {(1, d and date(2001, 1, d), k) for d in (None, 1, 2, 6, 7) for k in ("a=b", "c")}
    expected |= {(2, date(2001, 1, 3), "a=b"), (2, date(2001, 1, 3), "c"), (2, date(2001, 1, 5), "a=b")}
    for _ in range(2):
        refresh_partitions(source, "refreshed_by_two", "day", date(2001, 1, 3), date(2001, 1, 5))
        assert {tuple(r) for r in spark.table("refreshed_by_two").collect()} == expected
    after = dict(_files(spark, "refreshed_by_two"))
    assert all(after[f] == changed for f, changed in untouched.items())
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def _files(spark, table):
    return [tuple(r) for r in spark.table(table).select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()]


def test_staging_is_removed_after_use_and_after_errors(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("*"))
    with staging(spark) as keep:
        assert keep(spark.range(5), "kept").count() == 5
        assert set(shared.glob("*")) != before
    with pytest.raises(ZeroDivisionError), staging(spark) as keep:
        keep(spark.range(5), "kept")
        1 / 0
    assert set(shared.glob("*")) == before


def test_scope_removes_what_its_queries_have_staged(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("*"))
    with scope(spark):
        df = stage(spark.range(5), "scoped")
        with scope(spark):
            assert stage(df.filter("id > 1"), "inner").count() == 3
        assert df.count() == 5 and len(set(shared.glob("*")) - before) == 1
    with pytest.raises(ZeroDivisionError), scope(spark):
        stage(spark.range(5), "scoped")
        1 / 0
    assert set(shared.glob("*")) == before


def test_order_facts_stay_compiled(spark, tmp_path):
    rows = {
        "customer": "1L AS c_custkey, 1 AS c_nationkey, 'BUILDING' AS c_mktsegment",
        "orders": "1L AS o_orderkey, 1L AS o_custkey, 'O' AS o_orderstatus, 1D AS o_totalprice, TIMESTAMP_NTZ'2001-01-01 00:00:00' AS o_orderdate, '5-LOW' AS o_orderpriority",
        "lineitem": "1L AS l_orderkey, 1L AS l_partkey, 1L AS l_suppkey, 1 AS l_linenumber, 1D AS l_quantity, 1D AS l_extendedprice, 'N' AS l_returnflag",
        "part": "1L AS p_partkey, 1 AS p_size",
        "events": "1L AS event_id, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts, 1L AS user_id, 'view' AS event_type, 1D AS value",
    }
    for name, columns in rows.items():
        spark.sql(f"SELECT {columns}").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        orders = positions.order_facts(sample_sources(spark, str(tmp_path)).positions, sample_params())
        said = io.StringIO()
        with contextlib.redirect_stdout(said):
            orders.explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # Java runs methods of more than 8,000 bytes uncompiled.
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", said.getvalue())]
    assert sizes and max(sizes) < 7500


def test_partner_features_stay_compiled(spark, sources):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        said = io.StringIO()
        with contextlib.redirect_stdout(said):
            datamart.partner_features(sources, sample_params()).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", said.getvalue())]
    assert sizes and max(sizes) < 8000


def test_a_position_passes_no_calendar_or_decimal_buffer(sources):
    orders = positions.order_facts(sources.positions, sample_params(), datamart.ORDER_MEASURES)
    assert not [name for name, kind in orders.dtypes if kind.startswith("decimal")]
    assert {"StornoWert_ges", "Nabs_katbez", "LifetimeNetSalesAmt"}.isdisjoint(orders.columns)
    plan = plan_of(orders).split("== Physical Plan ==")[-1]
    assert not re.search(r"cast\((orderdate|reportingdate)#\d+ as date\)", plan)


def test_cents_and_shared_lifetime_measures(spark):
    """Unrounded quantities to the cent; demand from before the lifetime beside an order of it."""
    params = sample_params()
    early = (params.lifetime_start - timedelta(days=1)).isoformat()
    day = params.period(1).lo.isoformat()
    rows = [
        (1, day, day, 1, 7, "0.07", "10.50", "651"),
        (1, day, day, 1, 7, "-123456789012345.99", "1.00", "651"),
        (1, day, day, 5, 8, "2.50", "-2.50", "651"),
        (1, early, day, 1, 9, "4.00", "3.00", "651"),
        (1, day, day, 1, None, None, None, "651"),
    ]
    taken = spark.createDataFrame(
        [(b, o, r, t, i, q, v, c) for b, o, r, t, i, q, v, c in rows],
        "bpid long, orderdate string, reportingdate string, rectype int, orderid long, q string, v string, promotionpurchasecd string",
    ).selectExpr(
        "bpid", "DATE'1995-01-01' AS accountDate", "CAST(orderdate AS TIMESTAMP_NTZ) AS orderdate",
        "CAST(reportingdate AS TIMESTAMP_NTZ) + INTERVAL '86399' SECOND AS reportingdate", "rectype", "orderid",
        "CAST(q AS DECIMAL(18,2)) AS kpivalueqty", "CAST(v AS DECIMAL(18,2)) AS kpivaluevk", "20 AS catalogtypeid",
        "'i' AS orderchannelcd", "promotionpurchasecd", "'1' AS itemsize",
    )
    orders = stage(positions.order_facts(taken, params), "orders")
    half = positions.period_kpis_of(orders).collect()
    assert [(r.period, str(r.BadeBM_ges), r.Orders_ges, r.brums_ges) for r in half] == [("S1", "-123456789012345.92", 1, -3)]
    assert positions.period_kpis_of(orders).schema["BadeBM_ges"].dataType == T.DecimalType(38, 2)
    (life,) = positions.lifetime_kpis_of(orders).collect()
    assert (life.LifeTimeOrders, life.LifetimeOrdersOnline, life.LifetimeGrossSalesAmt, life.LifetimeNetSalesAmt) == (1, 1, -3, None)
    (demand,) = population.demand_profile_of(orders, params).collect()
    assert (demand.bbwS1, demand.nf) == (1450, 1450)


def test_upper_sql_agrees_with_upper(spark):
    texts = ["", "i", "Tis", "1-URGENT", "stück", "\u0131", "\u017f", "\ufb01", "\ufb06", "\u1e97", "ß", None]
    rows = spark.createDataFrame([(t,) for t in texts], "c string")
    tests = [f"contains(u, '{x}')" for x in "TIS"] + [f"u = '{x}'" for x in "TIS"]
    results = [rows.selectExpr("c", f"{sql} AS u").selectExpr("c", *tests).collect() for sql in (upper_sql("c", "TIS"), "upper(c)")]
    assert results[0] == results[1] and any(r[1] for r in results[0] if r[0] == "\u1e97")


@pytest.mark.parametrize("kind", ["DATE", "TIMESTAMP_NTZ", "TIMESTAMP"])
def test_in_days_sql_takes_dates_and_timestamps(spark, kind):
    texts = ["2001-01-31 23:59:59.999999", "2001-02-01 00:00:00", "2001-02-28 23:59:59.999999", "2001-03-01 00:00:00", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(f"CAST(t AS {kind}) AS t")
    found = [r[0] for r in rows.selectExpr(in_days_sql("t", date(2001, 2, 1), date(2001, 2, 28))).collect()]
    assert found == [False, True, True, False, None]
