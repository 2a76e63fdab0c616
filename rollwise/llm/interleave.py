"""Sharding by proportional stratified interleaving, with DataFrame operations only.

Rows are shuffled within their source by a seeded hash and ranked; row r of n gets the fraction
(r - 1/2) / n. Sorted by fraction, every stretch of rows holds the sources in the proportions of the
whole, so equal cuts give shards of the same mixture.

A source may hold a third of all rows, so no window spans a source. Rows fall into chunks by hash
range; a window numbers the rows of one chunk and the sizes of earlier chunks are added. Chunk
sizes are counts per (source, chunk), of about ``CHUNK_ROWS`` rows each, and are summed up in two levels,
so no window spans all chunks either. The order by fraction is numbered the same way. Rows without a
key, or with the same one, are drawn by what else they hold; more than a chunk of rows equal in every
column are drawn by where they were read, which is all the same, since they are interchangeable.

Defined cases: a null source is a source of its own; null doc_ids are drawn by the rest of the row;
repeated rows are placed one by one; rows equal in every column are interchangeable; no rows give no
rows; columns of any type and name (also with dots, or called as one of the results but for their
case, which are replaced) are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollwise.llm.staging import named, staged

CHUNK_ROWS = 4096
_DRAWS = 16**15


def draw(seed: int, *parts: Column) -> Column:
    """A number from 0 to 16**15 - 1 out of a seed and texts, null ones included."""
    digest = F.md5(F.to_json(F.array(F.lit(str(seed)), *parts)))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _starts(sizes: DataFrame, groups: list[str], chunk: str) -> DataFrame:
    """``sizes`` with ``start``, the sum of ``size`` over the earlier chunks of the group, in two levels."""
    block = F.floor(F.col(chunk) / CHUNK_ROWS)
    sizes = sizes.withColumn("block", block)
    before = Window.partitionBy(*groups).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.groupBy(*groups, "block").agg(F.sum("size").alias("whole"))
    blocks = blocks.withColumn("before", F.coalesce(F.sum("whole").over(before), F.lit(0)))
    blocks = blocks.select(*[F.col(g).alias(f"block_{g}") for g in groups], F.col("block").alias("of_block"), "before")
    inside = Window.partitionBy(*groups, "block").orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    match = F.col("block") == F.col("of_block")
    for g in groups:
        match = match & F.col(g).eqNullSafe(F.col(f"block_{g}"))
    summed = sizes.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(blocks, match)
    return summed.select(*groups, chunk, (F.col("before") + F.col("within")).alias("start"))


def _numbered(df: DataFrame, groups: list[str], chunk: str, order: list[str], out: str) -> DataFrame:
    """Number the rows of each group from 1 on in the order of (chunk, order)."""
    sizes = df.groupBy(*groups, chunk).agg(F.count(F.lit(1)).alias("size"))
    starts = _starts(sizes, groups, chunk).select(*[F.col(c).alias(f"of_{c}") for c in (*groups, chunk)], "start")
    match = F.col(chunk) == F.col(f"of_{chunk}")
    for g in groups:
        match = match & F.col(g).eqNullSafe(F.col(f"of_{g}"))
    inside = F.row_number().over(Window.partitionBy(*groups, chunk).orderBy(*order))
    return df.withColumn(out, inside).join(starts, match).withColumn(out, F.col(out) + F.col("start")).drop(*starts.columns)


def drawn(docs: DataFrame, seed: int, source: str, key: str, chunk_rows: int) -> DataFrame:
    """(row, source, at, tie): the rows as structs, with the number each is ordered by in its source."""
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    large = [c for c in kept if c.lower() == "text"]
    others = F.to_json(F.struct(*[named(c) for c in kept if c not in large]))
    tie = F.xxhash64(*[named(c).cast("string") for c in large], others)
    rows = docs.select(F.struct(*[named(c) for c in kept]).alias("row"), named(source).alias("source"), named(key).cast("string").alias("key"), tie.alias("tie"))
    rows = rows.withColumn("draw", draw(seed, F.col("key"), F.col("tie").cast("string")))
    # Equal rows alone have equal draws: where they are many, they are told apart by place. Such draws are
    # written first, so that Spark knows their size and moves no row to meet them while they are few.
    many = rows.groupBy("draw").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > chunk_rows)
    many = staged(many.select(F.col("draw").alias("many")), "repeated")
    spread = rows.withColumn("id", F.monotonically_increasing_id().cast("string")).join(many, F.col("draw") == F.col("many"), "left")
    apart = draw(seed, F.col("draw").cast("string"), F.col("id"))
    return spread.select("row", "source", "tie", F.when(F.col("many").isNull(), F.col("draw")).otherwise(apart).alias("at"))


def interleaved_shards(docs: DataFrame, shards: int, seed: int = 7, source: str = "source", key: str = "doc_id", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 within the shard).

    Shard sizes differ by one row at most, and so do a shard's rows of one source from their share
    up to rounding. Columns named shard or slot are replaced.
    """
    rows = drawn(docs, seed, source, key, chunk_rows)
    per_source = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    total = per_source.agg(F.sum("n")).first()[0] or 0
    chunks = max(1, -(-total // chunk_rows))
    rows = rows.withColumn("chunk", F.least(F.floor(F.col("at") / F.lit(float(_DRAWS)) * chunks), F.lit(chunks - 1)))
    of_source = per_source.select(F.col("source").alias("name"), "n")
    ranked = _numbered(rows, ["source"], "chunk", ["at", "tie"], "rank")
    ranked = ranked.join(of_source, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    fraction = (2 * F.col("rank") - 1) / (2 * F.col("n"))
    placed = ranked.withColumn("fraction", fraction).withColumn("band", F.least(F.floor(F.col("fraction") * chunks), F.lit(chunks - 1)))

    ordered = _numbered(placed, [], "band", ["fraction", "source", "at", "tie"], "position")
    position = F.col("position") - 1
    shard = F.floor(position * shards / F.lit(total)) if total else F.lit(0)
    first = F.ceil(F.col("shard").cast("long") * total / F.lit(shards))
    return ordered.withColumn("shard", shard.cast("int")).select("row.*", "shard", (position - first).cast("long").alias("slot"))
