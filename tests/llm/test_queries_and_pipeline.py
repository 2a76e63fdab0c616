"""Registered queries against DuckDB, and the pipeline against brute force."""

from __future__ import annotations

import base64
import hashlib
import html as html_entities
import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from compare import assert_same
from plain import components, level_targets, shingles, words
from pyspark.sql import functions as F

import corpus_pipeline
from rollwise.llm.mixture import SEED
from rollwise.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, tables, name):
    assert_same(QUERIES[name](spark, SF), tables.sql(SQL[name]))


def test_language_query(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op4_language_mixture"](spark, SF).collect()
    assert len(rows) == len(truth)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert held and sum(held) >= 0.95 * len(held)


def test_shard_query(spark):
    rows = QUERIES["op7_interleaved_shards"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1


def test_page_queries(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = {r.page_id: r for r in QUERIES["op6_wrapper_extraction"](spark, SF).collect()}
    assert set(found) == set(pages)
    for page, html in pages.items():
        article = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        want = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", article))
        assert found[page].text == " ".join(html_entities.unescape(want).split()) and found[page].n_chars == len(found[page].text)
    records = {r.page_id: r for r in QUERIES["op10_warc_segments"](spark, SF).collect()}
    for page, html in pages.items():
        assert records[page].payload_bytes == len(html.encode())
        assert records[page].payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()


def test_pipeline(spark):
    """Each stage against plain Python over what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, None, None, 0), (9002, "12 34", "en", "src0", 5), (None, "no id here at all", "en", None, 1)], docs.schema)
    docs = docs.union(extra)
    # Names that the operators use themselves, names with dots, and types that have no order.
    others = ("a.b", "row", "document", "copies", "target", "lang_pred", "component_id", "rank")
    docs = docs.select("*", *[F.concat(F.lit(n), F.col("n_chars").cast("string")).alias(n) for n in others], F.create_map(F.lit("k"), F.col("n_chars")).alias("map"))
    items = [shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        given, columns = docs.collect(), docs.columns
        out = stage(spark, docs, SF)
        docs = spark.createDataFrame(out.collect(), out.schema)
        kept = docs.collect()
        assert docs.columns == columns + (["shard", "slot"] if name == "sharding" else [])
        texts = {r.doc_id: r.text for r in given}
        if name == "language_id":
            assert {r.doc_id for r in given} - {r.doc_id for r in kept} == {9001, 9002}
        elif name == "ngram_jaccard_join":
            lowest = components({d: t for d, t in texts.items() if d is not None})
            assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({d for d in lowest if lowest[d] == d})
        elif name == "benchmark_decontamination":
            clean = [d for d, t in texts.items() if not any(100 * len(shingles(t) & i) >= 75 * len(i) for i in items)]
            assert sorted(map(str, (r.doc_id for r in kept))) == sorted(map(str, clean))
        elif name == "source_mixture":
            sizes = Counter()
            for r in given:
                sizes[r.source] += len(words(r.text))
            targets = level_targets(sizes)
            want = Counter()
            for r in given:
                rate = targets[r.source] / sizes[r.source] if sizes[r.source] else 0.0
                key = str(r.doc_id) if r.doc_id is not None else hashlib.md5((r.text or "").encode()).hexdigest()
                draw = int(hashlib.md5(f"{SEED}:{key}".encode()).hexdigest()[:13], 16) / 16**13
                want[(r.doc_id, r.text)] += int(rate) + (draw < rate % 1)
            assert Counter((r.doc_id, r.text) for r in kept) == +want
        else:
            assert Counter(r.doc_id for r in kept) == Counter(r.doc_id for r in given)
            sizes = Counter(r.shard for r in kept)
            assert set(sizes) == set(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1
            slots = {s: sorted(r.slot for r in kept if r.shard == s) for s in sizes}
            assert all(x == list(range(sizes[s])) for s, x in slots.items())
            for source, n in Counter(r.source for r in kept).items():
                held = Counter(r.shard for r in kept if r.source == source)
                assert all(abs(held[s] - n / 40) <= 2 for s in sizes)
        # What is kept is kept whole.
        others_of = {(r.doc_id, r.text): tuple(r[c] for c in others) for r in given}
        assert all(tuple(r[c] for c in others) == others_of[(r.doc_id, r.text)] for r in kept)
    empty = docs.drop("shard", "slot").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF).drop("shard", "slot")
    assert empty.columns == columns and empty.count() == 0
