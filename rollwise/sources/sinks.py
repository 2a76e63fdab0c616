"""Durable outputs, staged intermediates and the date-range refresh of a partitioned table.

Each change of a table is arranged so that it can be read at any time and a run that fails can be
repeated: new files are complete before the catalog names them, and old ones go last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import date
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwise.functions.scalars import in_days

#: (df, name, *partition_by, bucket_by=()) -> what was written.
Stage = Callable[..., DataFrame]

# Fixed value: the name of a partition without a value.
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

#: Partitions named in one catalog statement.
_NAMED_AT_ONCE = 500

_session_folders: dict[str, str] = {}
_scope: ContextVar[str | None] = ContextVar("rollwise_scope", default=None)


def new_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: in ``spark.checkpoint.dir``, or where that is
    unset beside the tables of the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/staged"
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}-{uuid4().hex}"


def _on_filesystem(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, path: str) -> None:
    hadoop, system = _on_filesystem(spark, path)
    system.delete(hadoop, True)


def session_folder(spark: SparkSession) -> str:
    """The folder for intermediates of lazily read results: that of the innermost ``scope``, else one
    that goes when the driver's JVM ends."""
    if (scoped := _scope.get()) is not None:
        return scoped
    app = spark.sparkContext.applicationId
    if app not in _session_folders:
        _session_folders[app] = new_folder(spark)
        path, system = _on_filesystem(spark, _session_folders[app])
        system.deleteOnExit(path)
    return _session_folders[app]


def _written(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str, *partition_by: str, bucket_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the session's shared folder and read it back.

    Consumers then share one computation, read only the columns they need, plan with true sizes,
    and lost executors never cause the work upstream to be repeated. ``bucket_by`` needs a catalog entry
    with an end and is heeded inside ``staging`` only.
    """
    return _written(df, f"{session_folder(df.sparkSession)}/{name}-{uuid4().hex}", *partition_by)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Stage]:
    """Like ``stage``, in a folder that is removed on leaving the block, also after an error.

    Results that read it have to be written or collected inside the block. With ``bucket_by``, rows are
    dealt by those columns into as many buckets as a shuffle has partitions, so every later join or
    aggregate by them reads the buckets where they are, without another exchange of this side. Spark
    does not split a bucket, so this is for keys that do not repeat.
    """
    folder, tables = new_folder(spark), []

    def keep(df: DataFrame, name: str, *partition_by: str, bucket_by: Sequence[str] = ()) -> DataFrame:
        path = f"{folder}/{name}-{uuid4().hex}"
        if not bucket_by:
            return _written(df, path, *partition_by)
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        tables.append(f"staged_{uuid4().hex}")
        # Dealt as buckets are, so a task writes one file.
        writer = df.repartition(buckets, *bucket_by).write.format("parquet").bucketBy(buckets, *bucket_by)
        writer.option("path", path).saveAsTable(tables[-1])
        return spark.table(tables[-1])

    try:
        yield keep
    finally:
        for table in tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        _remove(spark, folder)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Everything staged inside the block, by whichever query, is removed on leaving it.

    A long session wraps each query and the reading of its result: ``with scope(spark): query(...).write...``.
    Scopes may be nested; threads and tasks of an event loop each have their own.
    """
    folder = new_folder(spark)
    token = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(token)
        _remove(spark, folder)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _described(spark: SparkSession, table: str, partition: str = "") -> dict[str, str]:
    """Catalog properties of a table, or of one of its partitions."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition}").collect()
    start = max(i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed"))
    return {r["col_name"]: r["data_type"] for r in reversed(rows[start:])}


def write_durable(df: DataFrame, table: str) -> None:
    """Create or replace the output table ``table``.

    The rows are written to a new folder beside the table's database; then one catalog statement points
    the table at it. Until then, and for good if the write fails, readers see the old content. The folder
    of the content just replaced stays until the next write, so queries under way can end; older ones
    are removed. Only a table whose columns change is dropped and created anew, after the write.
    """
    spark = df.sparkSession
    *database, name = table.split(".")
    home = spark.catalog.getDatabase(".".join(database) or spark.catalog.currentDatabase()).locationUri.rstrip("/")
    versions = f"{home}/{name}.versions"
    fresh = f"{versions}/{uuid4().hex}"
    try:
        df.write.parquet(fresh)
    except BaseException:
        _remove(spark, fresh)
        raise
    columns = [(f.name, f.dataType) for f in df.schema]
    exists, previous = spark.catalog.tableExists(table), None
    if exists:
        previous = _described(spark, table).get("Location")
        if [(f.name, f.dataType) for f in spark.table(table).schema] != columns or _described(spark, table)["Provider"] != "parquet":
            spark.sql(f"DROP TABLE {table}")
            exists = False
    if not exists:
        spark.sql(f"CREATE TABLE {table} ({', '.join(f'`{n}` {t.simpleString()}' for n, t in columns)}) USING parquet")
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(fresh)}")
    spark.catalog.refreshTable(table)
    _, system = _on_filesystem(spark, versions)
    kept = {_on_filesystem(spark, path)[0].getName() for path in (fresh, previous or fresh)}
    for status in system.listStatus(_on_filesystem(spark, versions)[0]):
        if status.getPath().getName() not in kept:
            system.delete(status.getPath(), True)


def refreshed(target: DataFrame, source: DataFrame, column: str, lo: date, hi: date) -> DataFrame:
    """Content of ``target`` after its days [lo, hi] have been replaced by those of ``source``."""
    in_range = in_days(target, column, lo, hi)
    kept = target.filter(~F.coalesce(in_range, F.lit(False)))
    return kept.unionByName(source.filter(in_days(source, column, lo, hi)))


def _partition(values: dict[str, str | None]) -> str:
    return "PARTITION (" + ", ".join(f"`{k}` = " + ("NULL" if v is None else _quoted(v)) for k, v in values.items()) + ")"


def _in_chunks(specs: list[str]) -> Iterator[list[str]]:
    for lo in range(0, len(specs), _NAMED_AT_ONCE):
        yield specs[lo : lo + _NAMED_AT_ONCE]


def _drop_partitions(spark: SparkSession, table: str, specs: list[str]) -> None:
    """Remove partitions with their files, of managed and of external tables.

    Files go first: a partition that is still named but empty reads as what it shall be, and a repeated
    run finds and drops it. The other way round its files would stay where nobody looks.
    """
    for spec in specs:
        _remove(spark, _described(spark, table, spec)["Location"])
    for some in _in_chunks(specs):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(some)}")


def refresh_partitions(source: DataFrame, table: str, day_column: str, lo: date, hi: date) -> None:
    """Replace the days [lo, hi] of ``table``, partitioned by the date ``day_column`` and maybe more.

    Only partitions of the range are touched; rows without a day stay. First the partitions that the
    source has are overwritten and the new ones of them named in the catalog, then those it no longer has
    are removed, also from an external table; a repeated run gives the same table, after a failure too.
    Rows are dealt by day, and Spark splits a day with too many of them, so a day is written in few
    files. The driver handles the names of the range's partitions only.
    """
    spark = source.sparkSession
    fresh = source.filter(in_days(source, day_column, lo, hi)).select(*spark.table(table).columns)
    keys = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    present = {tuple(row) for row in fresh.select(*[F.col(k).cast("string") for k in keys]).distinct().toLocalIterator()}
    named = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator():
        parts = dict(part.split("=", 1) for part in row[0].split("/"))
        values = {k: None if v == _NULL_PARTITION else unquote(v) for k, v in parts.items()}
        if values[day_column] is not None and lo <= date.fromisoformat(values[day_column]) <= hi:
            named.append(tuple(values[k] for k in keys))
    if present:
        # Written to the table's files: only there can the overwrite mode be set for this one write.
        about = _described(spark, table)
        spread = fresh.hint("rebalance", *keys)
        writer = spread.write.format(about["Provider"]).partitionBy(*keys).option("partitionOverwriteMode", "dynamic")
        writer.mode("overwrite").save(about["Location"])
        for some in _in_chunks([_partition(dict(zip(keys, values))) for values in sorted(present - set(named), key=str)]):
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(some)}")
    _drop_partitions(spark, table, [_partition(dict(zip(keys, values))) for values in named if values not in present])
    spark.catalog.refreshTable(table)
