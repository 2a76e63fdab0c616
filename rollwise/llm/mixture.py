"""Mixing sources to target weights.

Words are summed per source; targets follow the weights, capped per source, and the excess is shared
among the others by weight until none is above its cap. A source's repetition rate is its target
over its size: each of its documents is emitted floor(rate) times, and once more when a number drawn
from a hash of (seed, document) lies below the fraction of the rate. The draw depends on the document
alone, so reruns agree and no document waits for another.

Defined cases: a null source is a source and comes last in the order; null or blank texts have size
0; a document without doc_id draws by its text; repeated rows draw alike; an empty table gives an
empty mixture; columns of the input are passed through whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwise.llm.staging import named, staged
from rollwise.operators.numbering import number_rows

SEED = "mixture-1"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2


def word_count(text: str) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a column; null has none."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) for ``sizes`` (source, size): one row per source.

    Weights repeat along the sources in code point order, null last. With every target at
    min(cap, level * weight), the level is raised round by round: capped sources stand aside and
    what they leave is shared by the rest. A round is one small aggregate over the sources.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_last", F.col("source").isNull().cast("int"))
    ranked = number_rows(sums, [], ["_last", "source"], staged, "_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    sources = staged(ranked.select("source", "source_size", weight.alias("w"), (F.col("source_size") * cap).alias("most")), "sources")
    total, level_weight = sources.agg(F.sum("source_size"), F.sum("w")).first()
    if not total:
        return sources.select("source", "source_size", F.lit(0.0).alias("target"))
    goal = share * total
    level, before = goal / level_weight, None
    while level != before:
        full = F.col("w") * level >= F.col("most")
        capped, rest = sources.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("w")))).first()
        if rest is None:
            break
        level, before = (goal - (capped or 0)) / rest, level
    target = F.least(F.col("w") * F.lit(level), F.col("most").cast("double"))
    return sources.select("source", "source_size", target.alias("target"))


def copies(rate: Column, identity: Column, seed: str = SEED) -> Column:
    """floor(rate), plus one with the probability of the fraction."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), identity)), 1, 13)
    draw = F.conv(digits, 16, 10).cast("long") / F.lit(float(16**13))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def identity(key: str = "doc_id", text: str = "text") -> Column:
    return F.coalesce(F.col(key).cast("string"), F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def with_copies(docs: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` (identity, source, size and others) with source_size, target and copies."""
    of = targets.select(F.col("source").alias("_source"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return docs.join(of, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("copies", copies(rate, F.col("identity"), seed))


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """The mixture itself: rows of ``docs`` (doc_id, text, source and others), each as often as taken."""
    targets = source_targets(docs.select("source", word_count("text").alias("size")), weights, share, cap)
    rows = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("row"), "source", identity().alias("identity"))
    return with_copies(rows, targets, seed).select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
