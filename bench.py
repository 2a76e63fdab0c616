"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the sample folder, ``BENCH_CPUS`` the number of local cores. The ten inputs are
derived from the sample once and stored, as a user has them; how long that takes is given apart, as
``adapter_sec``. Every query is run once to warm up and then three times; the median counts. Results
go to the noop sink, so all rows and columns are computed, and what a run has staged is removed after
it. With ``BENCH_LITERAL=1`` the position measures are also computed period by period, with one scan
and four COUNT DISTINCT per half year, and the whole run with one read of the positions per statement.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwise.functions import in_days
from rollwise.operators import period_columns
from rollwise.params import Params
from rollwise.plans import population, positions
from rollwise.plans.population import ACCOUNT
from rollwise.queries import QUERIES
from rollwise.sources import Sources, read_sources, sample_params, sample_sources, scope, stage

HEADLINE = (
    "population_base",
    "position_kpis_wide",
    "lifetime_kpis",
    "order_quotes",
    "newsletter_funnel",
    "web_session_features",
    "style_interest",
    "datamart_webshop",
    "datamart_transactions",
    "datamart_full",
)
RUNS = 3


def session(cpus: str, folder: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rollwise-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        # A run has more generated classes than the default of 100 holds, and would compile them each time.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stored_sources(spark: SparkSession, sf_dir: str, folder: str) -> Sources:
    """The ten inputs, written once; the positions in as many files as there are tasks to read them."""
    for name, df in vars(sample_sources(spark, sf_dir)).items():
        spread = df.repartition(spark.sparkContext.defaultParallelism) if name == "positions" else df
        spread.write.parquet(f"{folder}/inputs/{name}")
    return read_sources(spark, folder=f"{folder}/inputs")


def literal_position_kpis(src: Sources, params: Params) -> DataFrame:
    """``position_kpis_wide`` with one scan, one aggregate and one join per half year."""
    blocks = []
    for p in params.periods:
        source = src.positions
        rows = source.filter(
            in_days(source, "orderdate", p.lo, p.hi) & in_days(source, "reportingdate", p.lo, p.last_reporting_day)
        )
        rows = rows.withColumns({name: F.expr(sql) for name, sql in positions.PREPARED.items()})
        aggregates = [
            f"count(DISTINCT CASE WHEN {m.when} THEN orderid END) AS {m.name}_{p.name}"
            if m.kind == "orders"
            else f"{m.per_order()} AS {m.name}_{p.name}"
            for m in positions.MEASURES
        ]
        blocks.append(rows.groupBy(*ACCOUNT).agg(*[F.expr(sql) for sql in aggregates]))
    return reduce(lambda left, right: left.join(right, list(ACCOUNT), "full"), blocks)


def literal_position_scans(src: Sources, params: Params) -> DataFrame:
    """The eleven reads of the positions in a run written statement by statement, joined per account:
    inactivity, demand, eight half years and the lifetime."""
    parts = [
        population.recent_demand(src.positions, params),
        population.demand_by_period(src.positions, params),
        literal_position_kpis(src, params),
        positions.lifetime_kpis(src.positions, params),
    ]
    return reduce(lambda left, right: left.join(right, list(ACCOUNT), "full"), parts)


def shared_position_scan(src: Sources, params: Params) -> DataFrame:
    """The same from one read: order facts staged, all else from them."""
    orders = stage(positions.order_facts(src.positions, params), "orders")
    kpis = period_columns(positions.period_kpis_of(orders), ACCOUNT, params.periods, positions.MEASURE_NAMES)
    parts = [population.demand_profile_of(orders, params), kpis, positions.lifetime_kpis_of(orders)]
    return reduce(lambda left, right: left.join(right, list(ACCOUNT), "full"), parts)


def seconds(query: Callable[[Sources, Params], DataFrame], src: Sources) -> float:
    start = time.perf_counter()
    with scope(src.positions.sparkSession):
        query(src, sample_params()).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    todo = {name: QUERIES[name] for name in HEADLINE}
    if os.environ.get("BENCH_LITERAL") == "1":
        todo = {
            "position_kpis_wide": QUERIES["position_kpis_wide"],
            "position_kpis_literal": literal_position_kpis,
            "positions_one_scan": shared_position_scan,
            "positions_eleven_scans": literal_position_scans,
        }
    times = {}
    with tempfile.TemporaryDirectory(prefix="rollwise-bench-") as folder:
        spark = session(cpus, folder)
        start = time.perf_counter()
        src = stored_sources(spark, sf_dir, folder)
        adapter = round(time.perf_counter() - start, 3)
        for name, query in todo.items():
            seconds(query, src)
            times[name] = round(statistics.median(seconds(query, src) for _ in range(RUNS)), 3)
            print(f"{name}: {times[name]} s", file=sys.stderr, flush=True)
        spark.stop()
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": scale, "adapter_sec": adapter}))


if __name__ == "__main__":
    main()
