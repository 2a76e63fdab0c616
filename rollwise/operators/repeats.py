"""Rows that stand for several equal rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIMES = "_times"
_CHUNK = 1024


def split_copies(df: DataFrame, number: str | None = None) -> DataFrame:
    """Split rows with a large ``_times`` into rows of at most 1024 copies each.

    Done on few columns, this keeps the array behind each later copy short. ``number`` names the
    column with the first of the row's consecutive numbers, which moves along.
    """
    split = df.withColumn("_chunk", F.expr(f"explode(sequence(0L, ({TIMES} - 1) div {_CHUNK}))"))
    moved = {TIMES: F.expr(f"least({_CHUNK}L, {TIMES} - _chunk * {_CHUNK})")}
    if number is not None:
        moved[number] = F.expr(f"{number} + _chunk * {_CHUNK}")
    return split.withColumns(moved).drop("_chunk")


def repeat_rows(df: DataFrame, number: str | None = None) -> DataFrame:
    """Write out each row ``_times`` times, inside its task; every copy gets its own ``number``."""
    copies = df.withColumn("_copy", F.expr(f"explode(sequence(1L, {TIMES}))"))
    columns = [c for c in df.columns if c != TIMES]
    return copies.selectExpr(*[f"{c} + _copy - 1 AS {c}" if c == number else c for c in columns])
