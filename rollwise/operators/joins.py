"""Joins that Spark has no single call for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot from this share of all rows on, so 1 / HOT_SHARE keys are hot at most at any size.
HOT_SHARE = 1e-4
SALTS = 64


def absent_from(left: DataFrame, right: DataFrame, keys: Sequence[str], sentinel: str = "bpid") -> DataFrame:
    """Rows of ``left`` without a match in ``right``.

    A right key whose ``sentinel`` column is 0 counts as absent, so such rows of ``left`` stay.
    """
    return left.join(right.filter(F.col(sentinel) != 0), list(keys), "left_anti")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Column,
    how: str = "inner",
    weight: Column | None = None,
    hot_share: float = HOT_SHARE,
    salts: int = SALTS,
) -> DataFrame:
    """Inner or left join on ``key`` where one key, or rows without a key, may hold much of ``left``, and
    ``right`` has few rows per key.

    Keys with more than ``hot_share`` of the rows in ``left`` (counted by ``weight`` where a row stands
    for several) are split over ``salts`` tasks by a hash of ``spread_by``; their rows in ``right`` are
    repeated once per salt. Rows of ``left`` without a key match nothing; a left join keeps them, and they
    are split likewise, however many there are. All other keys join as usual. Fewer than 1 / hot_share
    keys can be hot: that bound is what makes the set safe to broadcast, and ``left`` is not shuffled to
    mark them. ``left`` is read twice.
    """
    if how == "inner":
        left = left.filter(F.col(key).isNotNull())
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = left.groupBy(key).agg(rows.alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    often = (F.col("_rows") > hot_share * total) & F.col(key).isNotNull()
    hot = F.broadcast(counts.filter(often).select(key, F.lit(True).alias("_hot")))
    spread = F.coalesce(F.col("_hot"), F.col(key).isNull())
    split = left.join(hot, key, "left").withColumn(
        "_salt", F.when(spread, F.pmod(F.xxhash64(spread_by), F.lit(salts))).otherwise(0).cast("int")
    )
    every_salt = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.filter(F.col(key).isNotNull()).join(hot, key, "left").withColumn("_salt", F.explode(every_salt))
    return split.drop("_hot").join(repeated.drop("_hot"), [key, "_salt"], how).drop("_salt")
