"""Connected components of a graph kept as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwise.llm.staging import staged
from rollwise.sources.sinks import Stage


def connected_components(edges: DataFrame, stage: Stage = staged) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long): the smallest node reached.

    Alternates the large-star and small-star steps until a round changes nothing: every node points
    at the smallest neighbour it knows, so stars merge and the number of rounds grows with the
    logarithm of the longest path. Edges never outnumber those of the input by more than the nodes.
    Nulls and loops are ignored; no edges give no rows.
    """
    links = stage(
        edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    mark = _mark(links)
    while True:
        both = links.union(links.select("b", "a")).toDF("a", "b")
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.filter("a <> b").distinct(), "large-star")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        links = stage(small.filter("a <> b").distinct(), "small-star")
        before, mark = mark, _mark(links)
        if mark == before:
            break
    return links.toDF("node", "component").union(links.select("b", "b").distinct())


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
