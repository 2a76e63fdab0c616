"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A text's set is its distinct 5-word shingles. Two texts link when the Jaccard similarity of their
sets is at least ``percent`` / 100. Steps, each a Spark job over written intermediates:

1. *Frequencies.* Shingle hashes go to buckets as packed byte arrays, one row per bucket and block
   of texts, without an index row per shingle. A bucket counts in how many texts each shingle is and
   sends back those with two or more. Shingles so common that they could overfill a bucket are found
   first (Misra-Gries summaries, a bounded list) and counted beside it.
2. *Prefixes.* A block of texts then knows the rare-first order of each text. Shingles of one text
   alone come first and can match nothing; when they fill the prefix, the text has no partner.
3. *Candidates.* The remaining prefix shingles are joined. A posting list is joined with its most
   central text only, the one of the most frequent shingles. Length and positional filters act in
   the join, the suffix filter on small signatures after it.
4. *Verification.* Each distinct pair is compared once on its full shared shingles.
5. *Components* of the links, by large-star and small-star rounds.
6. *Remaining pairs.* Only lists whose members are in different components can still hold a link that
   joins two. Texts that such lists connect form a block, or several of about ``BLOCK_SHINGLES`` that
   meet pairwise; a task counts the overlaps of its block and returns the links that join
   components. So pairs of one group never become rows, and no component misses a link.
7. *All links*, only where they are read. A link lies within a component, so each component is cut
   as the blocks are and all its pairs are compared exactly. ``jaccard_join`` returns them as pairs;
   ``link_counts`` counts them for each text, which makes no pair a row.

Defined cases: null or blank texts have an empty set and no link; texts under five words have their
whole sequence as one shingle; rows with equal word sequences are one text; rows that repeat a
doc_id are one document; rows without doc_id are returned with a null component and link nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwise.llm.components import connected_components
from rollwise.llm.staging import staged
from rollwise.llm.words import U64, parts, sequence_key, shingle_set, word_hashes
from rollwise.sources.sinks import Stage

PERCENT = 75
#: Bytes of text whose shingles meet in one bucket.
BUCKET_BYTES = 4 << 20
#: Buckets at least: their number and 7 bytes then tell a 64-bit shingle id.
LEAST_BUCKETS = 256
#: Counters of a frequency summary: a shingle above 2 / SUMMARY of all is surely in the list.
SUMMARY = 1 << 15
#: Classes of the suffix signature.
CLASSES = 32
#: Shared shingles of the texts that one task compares with each other.
BLOCK_SHINGLES = 2 << 20
#: Links in one Arrow batch, about; a text's links stay together.
LINKS = 1 << 20

_LOW = U64((1 << 40) - 1)
_COMMON = 1 << 24


def _bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return ((ids >> U64(40)) % U64(buckets)).astype(np.int64)


def _pack(ids: np.ndarray) -> bytes:
    """Shingle ids, which are their whole 64-bit hashes at any size of the input."""
    return ids.astype("<u8").tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8").astype(U64)


def _shorten(ids: np.ndarray, buckets: int) -> np.ndarray:
    """What is left to tell of ids whose bucket is known: 56 bits, without loss."""
    return (ids >> U64(40)) // U64(buckets) << U64(40) | ids & _LOW


def _restore(short: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    return ((short >> U64(40)) * U64(buckets) + U64(bucket)) << U64(40) | short & _LOW


def _pack_short(short: np.ndarray) -> bytes:
    return np.ascontiguousarray(short.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def _unpack_short(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(raw, np.uint8).reshape(-1, 7)
    return out.view("<u8").ravel().astype(U64)


def _summary(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Misra-Gries summary of a task's shingles: counts fall short by at most their sum / size."""
    ids, counts = np.zeros(0, U64), np.zeros(0, np.int64)
    total = 0
    for batch in batches:
        for part in parts(batch, "text"):
            words, at = word_hashes(part.column("text"), lower=True)
            sets = [shingle_set(words[a:b]) for a, b in zip(at[:-1], at[1:])]
            new = np.concatenate(sets) if sets else np.zeros(0, U64)
            total += len(new)
            found, of = np.unique(new, return_counts=True)
            both = np.concatenate((ids, found))
            ids, inverse = np.unique(both, return_inverse=True)
            counts = np.bincount(inverse, np.concatenate((counts, of)), len(ids)).astype(np.int64)
            if len(ids) > size:
                counts = counts - np.partition(counts, len(counts) - size - 1)[len(counts) - size - 1]
                ids, counts = ids[counts > 0], counts[counts > 0]
    yield pa.record_batch({"id": pa.array(np.append(ids.view(np.int64), -1)), "n": pa.array(np.append(counts, total))})


def common_shingles(docs: DataFrame, size: int = SUMMARY, stage: Stage = staged) -> np.ndarray:
    """Shingles held by a share of at least 2 / size of all (text, shingle) pairs; sorted by
    (count, id). Never more than ``size`` of them, whatever the input."""

    def task(batches):
        yield from _summary(batches, size)

    sums = stage(docs.select("text").mapInArrow(task, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")), "summary")
    total = sums.filter("id = -1").agg(F.max("n")).first()[0] or 0
    # Counts fall short by total / size at most; what stays has at least total / size, so it is bounded.
    rows = sums.filter((F.col("id") != -1) & (F.col("n") > max(2, total / size))).orderBy("n", "id").collect()
    return np.array([r["id"] for r in rows], np.int64).view(U64)


def _blocks(batches: Iterator[pa.RecordBatch], buckets: int, common: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For each block of texts a head row, and a row for each bucket with its shingles."""
    task = TaskContext.get().partitionId() << 32
    order = np.argsort(common)
    table = common[order]
    for batch in batches:
        for part in parts(batch, "text"):
            task += 1
            words, at = word_hashes(part.column("text"), lower=True)
            texts = [words[a:b] for a, b in zip(at[:-1], at[1:])]
            sets = [shingle_set(x) for x in texts]
            sizes = np.array([len(x) for x in sets], np.int64)
            ids = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets), dtype=np.int64), sizes)
            where = np.searchsorted(table, ids)
            is_common = np.zeros(len(ids), bool)
            if len(table):
                is_common = table[np.minimum(where, len(table) - 1)] == ids
            head = {
                "doc_id": part.column("doc_id"),
                "n": pa.array(sizes),
                "key": pa.array([sequence_key(x) for x in texts], pa.binary()),
            }
            head = pa.record_batch(head)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, head.schema) as out:
                out.write_batch(head)
            rows = [(task % buckets, task, 0, np.bincount(owner[is_common], minlength=len(sets)).astype("<u4").tobytes(), order[where[is_common]].astype("<u4").tobytes(), sink.getvalue().to_pybytes())]
            ids, owner = ids[~is_common], owner[~is_common]
            bucket = _bucket(ids, buckets)
            by = np.argsort(bucket, kind="stable")
            ids, owner, bucket = ids[by], owner[by], bucket[by]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(ids)]):
                if hi > lo:
                    held = np.bincount(owner[lo:hi], minlength=len(sets)).astype("<u4")
                    rows.append((int(bucket[lo]), task, 1, held.tobytes(), _pack_short(_shorten(ids[lo:hi], buckets)), b""))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _ROW_TYPES)], _ROW_NAMES)


_ROW_NAMES = ["bucket", "block", "kind", "held", "ids", "head"]
_ROW_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
_ROWS = "bucket int, block long, kind int, held binary, ids binary, head binary"


def _count(table: pa.Table) -> pa.Table:
    """A bucket's shingles that several texts hold: their ids, then their frequencies."""
    rows = table.to_pylist()
    own = [r for r in rows if r["kind"] == 1]
    out = [tuple(r[c] for c in _ROW_NAMES) for r in rows if r["kind"] == 0]
    if own:
        lists = [_unpack_short(r["ids"]) for r in own]
        low, inverse, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        frequency = counts[inverse]
        at = 0
        for r, ids in zip(own, lists):
            f = frequency[at : at + len(ids)]
            at += len(ids)
            held = np.frombuffer(r["held"], "<u4")
            owner = np.repeat(np.arange(len(held)), held)[f > 1]
            if len(owner):
                raw = _pack_short(ids[f > 1]) + np.minimum(f[f > 1], 65535).astype("<u2").tobytes()
                out.append((r["bucket"], r["block"], 1, np.bincount(owner, minlength=len(held)).astype("<u4").tobytes(), raw, b""))
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, _ROW_TYPES)], _ROW_NAMES)


def _need(n: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a set of n with any partner."""
    return -(-percent * n // 100)


def _order(table: pa.Table, percent: int, buckets: int, common: np.ndarray) -> pa.Table:
    """Rare-first shared shingles of each text of a block; none where unshared ones fill the prefix."""
    rows = table.to_pylist()
    head = next(r for r in rows if r["kind"] == 0)
    texts = pa.ipc.open_stream(head["head"]).read_all()
    n = np.asarray(texts.column("n"))
    owners, ids, ranks = [], [], []
    for r in rows:
        held = np.frombuffer(r["held"], "<u4")
        owners.append(np.repeat(np.arange(len(held)), held))
        if r["kind"] == 0:
            rank = np.frombuffer(r["ids"], "<u4").astype(np.int64)
            ids.append(common[rank])
            ranks.append(rank + _COMMON)
        else:
            m = len(owners[-1])
            ids.append(_restore(_unpack_short(r["ids"][: 7 * m]), r["bucket"], buckets))
            ranks.append(np.frombuffer(r["ids"][7 * m :], "<u2").astype(np.int64))
    owner, ids, rank = np.concatenate(owners), np.concatenate(ids), np.concatenate(ranks)
    by = np.lexsort((ids, rank, owner))
    ids = ids[by]
    shared = np.bincount(owner, minlength=len(n))
    at = np.concatenate(([0], np.cumsum(shared)))
    stays = (n > 0) & (shared >= _need(n, percent))
    lists = [_pack(ids[at[i] : at[i + 1]]) if s else None for i, s in enumerate(stays)]
    weight = np.bincount(owner, np.log2(np.minimum(rank, 65535)), len(n)) / np.maximum(n, 1)
    return pa.table({
        "doc_id": texts.column("doc_id"), "n": pa.array(n), "alone": pa.array(n - shared), "central": pa.array(weight),
        "key": texts.column("key"), "shared": pa.array(lists, pa.binary()),
    })


def _postings(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The prefix shingles of each text that other texts hold, with their positions."""
    for batch in batches:
        docs, tokens, places, sizes, alones, centrals = [], [], [], [], [], []
        for doc, n, alone, central, raw in zip(*(batch.column(c).to_pylist() for c in ("doc", "n", "alone", "central", "shared"))):
            count = int(n - _need(np.int64(n), percent) + 1) - alone
            ids = _unpack(raw)[: max(0, count)]
            tokens.append(ids.view(np.int64))
            places.append(np.arange(len(ids)) + alone)
            for to, x in ((docs, doc), (sizes, n), (alones, alone), (centrals, central)):
                to.append(np.full(len(ids), x))
        if docs:
            yield pa.record_batch([pa.array(np.concatenate(x)) for x in (tokens, docs, sizes, places, alones, centrals)], ["token", "doc", "n", "place", "alone", "central"])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.bincount((_unpack(raw) % U64(CLASSES)).astype(np.int64), minlength=CLASSES).tolist() for raw in batch.column("shared").to_pylist()]
        yield pa.record_batch([batch.column("doc"), batch.column("n"), pa.array(rows, pa.list_(pa.int32()))], ["doc", "n", "signature"])


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [
            len(np.intersect1d(_unpack(x), _unpack(y), assume_unique=True))
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
        ]
        yield pa.record_batch([batch.column("a"), batch.column("b"), pa.array(both, pa.int64()), batch.column("na"), batch.column("nb")], ["a", "b", "both", "na", "nb"])


def _near(table: pa.Table, percent: int, skip: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(x, all others near it) by row number, for each text of a block that is not in component ``skip``.

    Where two cuts meet, pairs within one cut are left to the task of that cut.
    """
    n, cut, component = (np.asarray(table.column(c)) for c in ("n", "cut", "component"))
    apart = len(np.unique(cut)) > 1 or table.column("i")[0] != table.column("j")[0]
    lists = [_unpack(raw) for raw in table.column("shared").to_pylist()]
    sizes = np.array([len(x) for x in lists])
    _, token = np.unique(np.concatenate(lists), return_inverse=True)
    held = np.argsort(token, kind="stable")
    owner = np.repeat(np.arange(len(lists)), sizes)[held]
    count = np.bincount(token)
    first = np.cumsum(count) - count
    at = np.cumsum(sizes) - sizes
    for x in range(len(lists)):
        if component[x] == skip:
            continue
        own = token[at[x] : at[x] + sizes[x]]
        length = count[own]
        places = np.repeat(first[own] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        both = np.bincount(owner[places], minlength=len(lists))
        close = np.flatnonzero(100 * both >= percent * (n[x] + n - both))
        yield x, close[(close != x) & ((cut[close] != cut[x]) | (not apart))]


def _block_links(table: pa.Table, percent: int) -> pa.Table:
    """Links between texts of different components in a block, as many as join components."""
    doc = np.asarray(table.column("doc"))
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent.setdefault(up, up)
            x = up
        return x

    component = table.column("component").to_pylist()
    # A pair of the largest component needs no look, any other has a member outside it.
    largest = max(set(component), key=component.count)
    links = []
    for x, close in _near(table, percent, largest):
        for y in close:
            if (rx := root(component[x])) != (ry := root(component[int(y)])):
                parent[max(rx, ry)] = min(rx, ry)
                links.append((max(doc[x], doc[y]), min(doc[x], doc[y])))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _partners(table: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(doc, the other docs near it) for each doc of a block; rows that repeat a doc are one."""
    table = table.sort_by("doc")
    doc = np.asarray(table.column("doc"))
    near: list[np.ndarray] = []
    for x, close in _near(table, percent):
        near.append(doc[close])
        if x + 1 == len(doc) or doc[x + 1] != doc[x]:
            others = np.unique(np.concatenate(near))
            yield doc[x], others[others != doc[x]]
            near = []


def _all_links(table: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Every link of a block, once."""
    none = np.zeros(0, np.int64)
    a, b, held = [none], [none], 0
    for doc, others in _partners(table, percent):
        lower = others[others < doc]
        a.append(np.full(len(lower), doc))
        b.append(lower)
        held += len(lower)
        if held >= LINKS:
            yield pa.record_batch([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
            a, b, held = [none], [none], 0
    yield pa.record_batch([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


def _block_counts(table: pa.Table, percent: int) -> pa.Table:
    """How many docs of a block are near each of its docs."""
    found = [(doc, len(others)) for doc, others in _partners(table, percent)]
    return pa.table({"doc": pa.array([d for d, _ in found], pa.int64()), "n_links": pa.array([n for _, n in found], pa.int64())})


def _cut(members: DataFrame, sizes: DataFrame, block_shingles: int) -> DataFrame:
    """``members`` of blocks of the ``sizes`` (block, n), once for each pair of cuts (i, j) they meet in."""
    size = sizes.groupBy("block").agg(F.ceil(F.sum("n") / block_shingles).alias("cuts"))
    cut = F.pmod(F.xxhash64("doc"), F.col("cuts"))
    cuts = members.join(size, "block").withColumn("cut", cut).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
    return cuts.withColumn("i", F.least("cut", "other")).withColumn("j", F.greatest("cut", "other"))


def _possible(percent: int) -> F.Column:
    """Length and positional filter on postings x and y of one shingle.

    With overlap o, percent * union <= 100 * o means o >= percent * (nx + ny) / (100 + percent). At
    most the places from this one on can be shared, less if an earlier prefix shingle is.
    """
    left = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py")) + F.least(F.col("px") - F.col("ax"), F.col("py") - F.col("ay"))
    return (
        (F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * percent)
        & (left * (100 + percent) >= (F.col("nx") + F.col("ny")) * percent)
    )


def _verified(pairs: DataFrame, texts: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """(a, b) of ``pairs`` whose similarity suffices; every pair is looked at once."""
    sa = signatures.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
    sb = signatures.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
    most = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    left = pairs.join(sa, "a").join(sb, "b").filter(most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent).select("a", "b", "na", "nb")
    xs = texts.select(F.col("doc").alias("a"), F.col("shared").alias("x"))
    ys = texts.select(F.col("doc").alias("b"), F.col("shared").alias("y"))

    def overlaps(batches):
        yield from _overlaps(batches)

    counted = left.join(xs, "a").join(ys, "b").mapInArrow(overlaps, "a long, b long, both long, na long, nb long")
    return counted.filter(f"both * 100 >= {percent} * (na + nb - both)").select("a", "b")


@dataclass
class Join:
    """Results over what the stage has written; ``links`` and ``counts`` are computed when read."""

    #: doc_id, n_shingles, component_id, and doc: the smallest doc_id of the same text.
    rows: DataFrame
    #: (a, b) of every link.
    links: DataFrame
    #: (doc, n_links) of every text that has a link.
    counts: DataFrame


def jaccard_join(
    docs: DataFrame,
    percent: int = PERCENT,
    bucket_bytes: int = BUCKET_BYTES,
    summary: int = SUMMARY,
    block_shingles: int = BLOCK_SHINGLES,
    stage: Stage = staged,
) -> tuple[DataFrame, DataFrame]:
    """Texts of ``docs`` (doc_id long, text string) and the links that join them.

    First result, one row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id
    reached by links, itself included). Second: all links (a, b), a > b, between the smallest doc_ids
    of two different texts; a group of n texts may have n * (n - 1) / 2 of them, which are computed
    when the frame is read. Both read what ``stage`` has written.
    """
    join = joined(docs, percent, bucket_bytes, summary, block_shingles, stage)
    return join.rows.drop("doc"), join.links


def link_counts(
    docs: DataFrame,
    percent: int = PERCENT,
    bucket_bytes: int = BUCKET_BYTES,
    summary: int = SUMMARY,
    block_shingles: int = BLOCK_SHINGLES,
    stage: Stage = staged,
) -> DataFrame:
    """doc_id and n_links of each row of ``docs``: how many different texts its text links to."""
    join = joined(docs, percent, bucket_bytes, summary, block_shingles, stage)
    return join.rows.join(join.counts, "doc", "left").select("doc_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def joined(docs: DataFrame, percent: int, bucket_bytes: int, summary: int, block_shingles: int, stage: Stage) -> Join:
    """The join of ``docs``, see ``jaccard_join`` and ``link_counts``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(max(LEAST_BUCKETS, -(-volume // bucket_bytes)), (1 << 22) - 1))
    common = common_shingles(docs, summary, stage)
    shared_common = spark.sparkContext.broadcast(common)

    def blocks(batches):
        yield from _blocks(batches, buckets, shared_common.value)

    def order(table):
        return _order(table, percent, buckets, shared_common.value)

    def prefix(batches):
        yield from _postings(batches, percent)

    def signature(batches):
        yield from _signatures(batches)

    counted = docs.mapInArrow(blocks, _ROWS).groupBy("bucket").applyInArrow(_count, _ROWS)
    ordered = stage(counted.groupBy("block").applyInArrow(order, "doc_id long, n long, alone long, central double, key binary, shared binary"), "rare-first")

    alive = ordered.filter("shared IS NOT NULL AND doc_id IS NOT NULL")
    first = stage(alive.groupBy("key").agg(F.min("doc_id").alias("doc")), "texts")
    texts = stage(
        alive.select(F.col("doc_id").alias("doc"), "key", "n", "alone", "central", "shared").join(first, ["doc", "key"], "left_semi").drop("key"),
        "representatives",
    )
    postings = stage(texts.mapInArrow(prefix, "token long, doc long, n long, place long, alone long, central double"), "postings")
    signatures = texts.mapInArrow(signature, "doc long, n long, signature array<int>")

    rank = F.struct((-F.col("central")).alias("r"), F.col("doc"), F.col("n"), F.col("place"), F.col("alone"))
    lists = stage(postings.groupBy("token").agg(F.min(rank).alias("m"), F.max("doc").alias("top"), F.min("doc").alias("low")).filter("top <> low"), "lists")
    near = (
        postings.join(lists, "token")
        .select(F.col("doc").alias("x"), F.col("m.doc").alias("y"), F.col("n").alias("nx"), F.col("m.n").alias("ny"), F.col("place").alias("px"), F.col("m.place").alias("py"), F.col("alone").alias("ax"), F.col("m.alone").alias("ay"))
    )
    pairs = stage(_pairs(near, percent), "central-pairs")
    links = stage(_verified(pairs, texts, signatures, percent), "central-links")
    labels = stage(connected_components(links, stage), "central-components")

    label = F.coalesce("component", "doc")
    tagged = postings.join(labels.withColumnRenamed("node", "doc"), "doc", "left").select("token", "doc", label.alias("component"))
    mixed = stage(tagged.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("token"), "mixed")
    spokes = postings.join(mixed, "token").join(lists, "token").select(F.col("doc").alias("a"), F.col("m.doc").alias("b"))
    blocks_of = stage(connected_components(spokes, stage), "blocks")
    members = texts.join(blocks_of.withColumnRenamed("node", "doc").withColumnRenamed("component", "block"), "doc").join(labels.withColumnRenamed("node", "doc"), "doc", "left")
    members = members.select("block", "doc", "n", label.alias("component"), "shared")
    sizes = blocks_of.join(texts.select(F.col("doc").alias("node"), "n"), "node").select(F.col("component").alias("block"), "n")
    cuts = _cut(members, sizes, block_shingles)

    def block_links(table):
        return _block_links(table, percent)

    more = stage(cuts.groupBy("block", "i", "j").applyInArrow(block_links, "a long, b long"), "block-links")
    components = labels
    if not more.isEmpty():
        # Each text points at its component already, so few rounds are left.
        components = stage(connected_components(labels.toDF("a", "b").union(more), stage), "components")

    def all_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _all_links(pa.Table.from_batches(batches), percent)

    def counts(table):
        return _block_counts(table, percent)

    groups = components.withColumnRenamed("node", "doc").withColumn("block", F.col("component"))
    members = texts.select("doc", "n", "shared").distinct().join(groups, "doc")
    whole = _cut(members, members.select("block", "n"), block_shingles).groupBy("block", "i", "j")
    links = whole.applyInArrow(all_links, "a long, b long")
    n_links = whole.applyInArrow(counts, "doc long, n_links long").groupBy("doc").agg(F.sum("n_links").alias("n_links"))

    of_text = first.join(components.withColumnRenamed("node", "doc"), "doc", "left").select("key", "doc", label.alias("component_id"))
    rows = ordered.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("shared").isNotNull() & F.col("doc_id").isNotNull(), F.col("key")).alias("key"))
    rows = rows.join(of_text, "key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "doc")
    return Join(rows, links, n_links)


def _pairs(near: DataFrame, percent: int) -> DataFrame:
    return near.filter((F.col("x") != F.col("y")) & _possible(percent)).select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
