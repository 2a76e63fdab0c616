"""From raw documents to sharded training data: each stage is one operator of ``rollwise.llm``.

Stages take (spark, docs, sf_dir) and return the columns of documents; the last adds shard and slot.
``run`` writes each result to the shared folder and reads it again, so a lost executor never repeats an
earlier stage.

Defined cases: documents whose text is null or has no letter leave in the first stage; rows without
doc_id are never near-duplicates; repeated rows stay together through every stage (the first of a
group keeps all rows of its doc_id); an empty table passes through empty; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwise.llm.containment import decontaminated
from rollwise.llm.interleave import interleaved_shards
from rollwise.llm.jaccard_join import jaccard_join
from rollwise.llm.language_mixture import UNKNOWN, held_out, identify, learn
from rollwise.llm.mixture import mixed
from rollwise.llm.staging import named, staged
from rollwise.sources.sinks import staging

SHARDS = 40


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; ``lang`` is filled in where it is missing."""
    model = learn(docs.filter(~held_out()).select("text", "lang"))
    # The text goes to the tasks once; the other columns may have any names.
    rest = F.struct(*[named(c) for c in docs.columns if c != "text"]).alias("document")
    known = identify(docs.select(rest, "text"), model, keep_text=True).filter(F.col("lang_pred") != UNKNOWN)
    filled = {"text": F.col("text"), "lang": F.coalesce("document.lang", "lang_pred").alias("lang")}
    return known.select(*[filled.get(c, F.col("document").getField(c).alias(c)) for c in docs.columns])


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group."""
    with staging(spark) as stage:
        groups, _ = jaccard_join(docs, stage=stage)
        # Only these doc_ids are kept of what the join has written.
        gone = staged(groups.filter("component_id <> doc_id").select("doc_id").distinct(), "near-duplicates")
    return docs.join(gone, "doc_id", "left_anti").select(*[named(c) for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixed(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their slot in it."""
    return interleaved_shards(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identified),
    ("ngram_jaccard_join", without_near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("source_mixture", mixed_by_source),
    ("sharding", sharded),
]

#: SQL cannot express the language model; the pipeline is tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
