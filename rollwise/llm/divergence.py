"""Audit of how far the sources of a language diverge, by row-wise (Gustavson) accumulation.

Each (lang, source) group has a smoothed term distribution over the terms its language keeps. Two
groups diverge by the sum of f(p, q) = floor((p - q)**2 / (p + q)) over all kept terms. Almost all
counts are zero, and where both are, f depends on the two groups alone. So, with z_g the value of a
zero count in group g:

    D(g, h) = V f(z_g, z_h) + R(g, h) + R(h, g) + C(g, h)

R(g, h) corrects the zero baseline for the terms of g: the sum of f(p, z_h) - f(z_g, z_h), taken per
distinct value p of g. C(g, h) corrects it for the terms that both have. Group g walks its terms
through the term-major index and scatters f(p, q) - f(p, z_h) - f(q, z_g) + f(z_g, z_h) into one
dense accumulator over its peers h. No pair of postings is ever a row.

Terms are dealt into blocks by hash; a task accumulates the rows of one block and sends one sum per
pair of groups, which Spark adds. A block holds at least as many postings as the square of its
language's number of sources, so what the blocks send stays below what they read; a source or a
term in a third of all documents is spread over the blocks, or is one posting per source.

All arithmetic is in whole numbers: values of p in decimals of 38 digits, f in longs (p is at most
1,000,000,001). Sums of f are below 2 (10**9 + V) each.

Defined cases: null text, lang and source are ''; groups without kept terms have p from zero counts
alone; a language without kept terms diverges by 0; repeated rows and rows without doc_id are
documents of their own; a language with one source has no pair; no documents give no rows; other
columns are not read. The pairs of sources, the result itself, are the only square in it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollwise.llm.staging import staged
from rollwise.llm.words import parts

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
BLOCK_POSTINGS = 1 << 14
#: Terms a task holds before it sends what it has counted.
_HELD = 1 << 19
_PIECE = 1 << 22
_CELLS = 1 << 20

#: A-Z become a-z; all other ASCII separates terms. The bytes of other characters are left alone.
_FOLD = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a few megabytes at a time."""
    folded, pos = text.translate(_FOLD), 0
    while pos < len(folded):
        end = folded.find(b" ", pos + _PIECE)
        end = len(folded) if end < 0 else end
        yield folded[pos:end].split()
        pos = end


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n and docs, summed as far as a task's memory goes; term null counts the documents."""
    groups: dict[tuple, tuple[Counter, Counter]] = {}

    def sent():
        for (lang, source), (n, docs) in groups.items():
            terms = list(docs)
            for lo in range(0, len(terms), 1 << 16):
                some = terms[lo : lo + (1 << 16)]
                columns = [pa.array([x] * len(some), pa.string()) for x in (lang, source)]
                values = [pa.array([c[t] for t in some], pa.int64()) for c in (n, docs)]
                yield pa.record_batch([*columns, pa.array(some, pa.binary()).cast(pa.string()), *values], ["lang", "source", "term", "n", "docs"])
        groups.clear()

    for batch in batches:
        for part in parts(batch, "text"):
            texts = pc.cast(pc.fill_null(part.column("text"), ""), pa.binary()).to_pylist()
            for lang, source, text in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), texts):
                n, docs = groups.setdefault((lang or "", source or ""), (Counter(), Counter()))
                seen: set = set()
                for terms in _pieces(text):
                    n.update(terms)
                    seen.update(terms)
                docs.update(seen)
                docs[None] += 1
            if sum(len(docs) for _, docs in groups.values()) > _HELD:
                yield from sent()
    yield from sent()


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _accumulated(postings: pa.Table, peers: pa.Table) -> pa.Table:
    """Sums of R and C over one block of terms, for each pair of groups (lo before hi) of its language."""
    peers = peers.take(pc.sort_indices(peers, [("source", "ascending")]))
    names, z = peers.column("source").combine_chunks(), peers.column("z").to_numpy()
    term = pc.dictionary_encode(postings.column("term").combine_chunks()).indices.to_numpy(zero_copy_only=False)
    order = np.argsort(term, kind="stable")
    term, p = term[order], postings.column("p").to_numpy()[order]
    group = pc.index_in(postings.column("source").combine_chunks(), names).to_numpy(zero_copy_only=False)[order]
    starts = np.searchsorted(term, np.arange(term[-1] + 2 if len(term) else 1))
    levels, level = np.unique(z, return_inverse=True)
    found = []
    for g in np.unique(group).tolist():
        own = np.flatnonzero(group == g)
        mine, zero = p[own], z[g]
        values, times = np.unique(mine, return_counts=True)
        base = np.zeros(len(levels), np.int64)
        step = max(1, _CELLS // len(levels))
        for lo in range(0, len(values), step):
            gain = _f(values[lo : lo + step, None], levels[None, :]) - _f(zero, levels)[None, :]
            base += times[lo : lo + step] @ gain
        row = base[level]
        # The postings of the group's terms: the index is walked once for every group of a term.
        first, size = starts[term[own]], starts[term[own] + 1] - starts[term[own]]
        at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
        here = np.repeat(mine, size)
        later = group[at] > g
        at, here = at[later], here[later]
        peer, q = group[at], p[at]
        np.add.at(row, peer, _f(here, q) - _f(here, z[peer]) - _f(q, zero) + _f(zero, z[peer]))
        others = np.flatnonzero((row != 0) & (np.arange(len(row)) != g))
        found.append((np.minimum(others, g), np.maximum(others, g), row[others]))
    lo, hi, value = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
    lang = pa.array([peers.column("lang")[0].as_py() if len(peers) else ""] * len(lo), pa.string())
    return pa.table({"lang": lang, "lo": names.take(pa.array(lo)), "hi": names.take(pa.array(hi)), "value": pa.array(value)})


def _share(n: str, total: str, terms: str) -> Column:
    """p of a count; null without kept terms."""
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(20,0))) div CAST(nullif({total} + 2 * {terms}, 0) AS DECIMAL(20,0))")


def _diverged(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def source_divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, block: int = BLOCK_POSTINGS) -> DataFrame:
    """lang, source, part, item, value and rank for ``docs`` (text, lang, source).

    Part ``pair``: every other source of the language by divergence. Part ``term``: the ``top`` kept
    terms that the source has more of than its language, by their share of the divergence from it.
    """
    docs = docs.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")])
    counted = docs.mapInArrow(_counts, "lang string, source string, term string, n long, docs long")
    counts = staged(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")

    of_term = Window.partitionBy("lang", "term")
    postings = counts.filter("term IS NOT NULL").select(
        "lang", "source", "term", "n",
        F.sum("docs").over(of_term).alias("in_docs"),
        F.sum("n").over(of_term).alias("lang_n"),
        F.row_number().over(of_term.orderBy("source")).alias("nth"),
    )
    postings = staged(postings.filter(F.col("in_docs") >= least).drop("in_docs"), "postings")

    of_source = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = postings.groupBy("lang").agg(
        F.count("*").alias("postings"), F.sum("n").alias("lang_total"), F.sum(F.when(F.col("nth") == 1, 1).otherwise(0)).alias("terms")
    )
    groups = counts.filter("term IS NULL").select("lang", "source").join(of_source, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = groups.fillna(0, ["total", "postings", "lang_total", "terms"])
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    blocks = F.ceil(F.col("postings") / F.greatest(F.lit(block), F.col("sources") * F.col("sources"))).cast("int")
    groups = staged(groups.join(sources, "lang").withColumn("blocks", blocks).withColumn("z", _share("0", "total", "terms")), "groups")

    shares = postings.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total", "terms"))
    dealt = shares.select("lang", F.expr("CAST(pmod(xxhash64(term), blocks) AS INT)").alias("block"), "term", "source", "p")
    peers = groups.filter("blocks > 0").select("lang", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "source", "z")
    sums = dealt.groupBy("lang", "block").cogroup(peers.groupBy("lang", "block")).applyInArrow(_accumulated, "lang string, lo string, hi string, value long")
    sums = sums.groupBy("lang", "lo", "hi").agg(F.sum("value").alias("corrected"))

    one = groups.select("lang", "source", "z", "terms")
    other = groups.select("lang", F.col("source").alias("item"), F.col("z").alias("zero"))
    pairs = one.join(other, "lang").filter("source <> item").withColumns({"lo": F.least("source", "item"), "hi": F.greatest("source", "item")})
    whole = F.coalesce(F.col("terms") * _diverged("z", "zero"), F.lit(0)) + F.coalesce("corrected", F.lit(0))
    pairs = pairs.join(sums, ["lang", "lo", "hi"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", whole.alias("value"))

    above = shares.withColumn("q", _share("lang_n", "lang_total", "terms")).filter("p > q")
    terms = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _diverged("p", "q").alias("value"))

    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    leading = terms.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(ranked)).union(leading)
