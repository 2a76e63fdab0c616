"""The ten input tables: schemas, and readers for Parquet folders and catalog tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_DDL = {
    "positions": """bpid BIGINT, accountDate DATE, orderdate TIMESTAMP_NTZ, reportingdate TIMESTAMP_NTZ,
        rectype INT, orderid BIGINT, kpivalueqty DECIMAL(18,2), kpivaluevk DECIMAL(18,2),
        catalogtypeid INT, orderchannelcd STRING, promotionpurchasecd STRING, itemsize STRING""",
    "customer_overview": "bpid BIGINT, accountDate DATE, bptypeid STRING, birthdate DATE, salutationid INT",
    "address_overview": "bpid BIGINT, accountDate DATE",
    "partner_exclusion": """bpid BIGINT, exclusioncd INT, decisionfg INT,
        validfrom TIMESTAMP_NTZ, validto TIMESTAMP_NTZ""",
    "order_profit": "bpid BIGINT, reportingdate DATE, orderid BIGINT, orderprofit_crm DECIMAL(18,2), firmid INT",
    "clicks": "bpid BIGINT, datum DATE, send INT, opened INT, clicked INT, firmid INT",
    "permission_hist": """bpid BIGINT, accountDate DATE, push_perm INT, nl_perm INT,
        valid_from DATE, valid_to DATE""",
    "session": """ktnr_glob BIGINT, wkorbid BIGINT, mandant_id INT, partition_date DATE,
        session_length_sek BIGINT, page_visits BIGINT, page_visits_ads BIGINT, device INT,
        shopapi_client_type STRING, kauf_bool INT, wkorb_fill_bool INT, session_click INT, testkunde INT""",
    "session_hist": "ktnr BIGINT, wkorbid BIGINT, mandant_id INT, gilt_von DATE, gilt_bis DATE",
    "styleview": "wkorbid BIGINT, style_id BIGINT, mandant_id INT, partition_date DATE",
}


def schema_of(name: str) -> T.StructType:
    """Schema of an input table; parsing it needs an active session."""
    return T.StructType.fromDDL(_DDL[name])


@dataclass(frozen=True)
class Sources:
    """The inputs of a run. ``positions`` must already be restricted to one firm."""

    positions: DataFrame
    customer_overview: DataFrame
    address_overview: DataFrame
    partner_exclusion: DataFrame
    order_profit: DataFrame
    clicks: DataFrame
    permission_hist: DataFrame
    session: DataFrame
    session_hist: DataFrame
    styleview: DataFrame


def read_sources(spark: SparkSession, folder: str | None = None, database: str | None = None) -> Sources:
    """Read all inputs from ``folder/<table>`` (Parquet) or from tables and views of ``database``.

    The schema of a Parquet folder is given, not inferred, so no file is opened for planning and
    a column missing from old files reads as NULL. Date-partitioned folders are pruned by Spark.
    """

    def read(name: str) -> DataFrame:
        if folder is not None:
            return spark.read.schema(schema_of(name)).parquet(f"{folder}/{name}")
        return spark.table(f"{database}.{name}" if database else name).select(*schema_of(name).fieldNames())

    return Sources(**{name: read(name) for name in _DDL})
