"""Consecutive numbers within few, huge groups."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_rows(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    stage: Callable[[DataFrame, str], DataFrame],
    out: str = "rownumber",
    weight: str | None = None,
) -> DataFrame:
    """Number the rows of each group 1..n in ``order``; groups may be NULL.

    A row whose ``weight`` is w stands for w rows and gets the first of their w numbers.

    A window over the groups alone would sort a whole group in one task, and a group can hold a
    large part of all rows. Here the rows are cut into sampled ranges of (groups, order) of about
    equal size, numbered inside each range, and shifted by the size of the earlier ranges of their
    group. The cut is staged first, so both steps see the same ranges.
    """
    ranged = stage(
        df.repartitionByRange(*groups, *order).withColumn("_range", F.spark_partition_id()), "ranged"
    )
    weights = F.lit(1).cast("long") if weight is None else F.col(weight)
    sizes = ranged.groupBy(*groups, "_range").agg(F.sum(weights).alias("_size"))
    # At most one row per group and range.
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        *[F.col(g).alias(f"_{g}") for g in groups],
        F.col("_range").alias("_shift_range"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift"),
    )
    inside = Window.partitionBy(*groups, "_range").orderBy(*order)
    if weight is None:
        first = F.row_number().over(inside)
    else:
        before = inside.rowsBetween(Window.unboundedPreceding, -1)
        first = F.coalesce(F.sum(weight).over(before), F.lit(0)) + 1
    numbered = ranged.withColumn("_inside", first)
    match = F.col("_range") == F.col("_shift_range")
    for g in groups:
        match = match & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return numbered.join(shifts, match).select(
        *df.columns, (F.col("_shift") + F.col("_inside")).alias(out)
    )
