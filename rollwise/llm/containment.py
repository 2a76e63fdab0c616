"""Benchmark decontamination: short test items found inside long documents.

Items are partitioned by the number of their distinct 5-word shingles, in classes up to a power of
two u. A document is read in windows of 2u shingles, each starting u after the last, so an item's
passage lies within one window and fills a good part of it. Window and item have a one-permutation
MinHash signature of 4u bins: the smallest shingle hash in each. A bin in which both agree makes the
item a candidate of the document, which is then verified by exact containment: at least ``percent``
% of the item's shingles are in the whole document.

A window's bin can only agree where the window holds one of the items' own signature values, so the
other bins of a window are never computed. An item with three quarters of its shingles in one window
is missed only if every shared bin has a smaller hash from the rest of the window (under 1e-6 from
about ten shared shingles on). Items of up to ``SHORT`` shingles have an exact way beside it: every one of
their shingles makes a candidate wherever it occurs, so none of them is missed.

Items go to the executors block by block, ``BLOCK_SHINGLES`` of them at most beside the last item,
so what is broadcast has a fixed bound and a larger benchmark means more passes. What a block has
found is written, and its broadcast released, before the next block is read.

Defined cases: null and blank texts and items match nothing; a text under five words is one shingle,
so it matches an equal text only; repeated items and documents are reported each; null ids stay
null; empty tables give no rows; other columns are passed through by ``decontaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwise.llm.staging import staged
from rollwise.llm.words import U64, ngrams, parts, shingle_set, word_hashes

PERCENT = 75
BLOCK_SHINGLES = 1 << 18
#: Up to so many shingles, 75 % of an item may be too few for its signature to be safe.
SHORT = 16
_BITS = U64((1 << 20) - 1)


def _bins(size: int) -> int:
    """Class limit u of an item of so many shingles."""
    return 1 << max(0, int(size - 1).bit_length())


@dataclass
class ItemIndex:
    """Signature values of a block of items, by size class."""

    ids: list
    shingles: list[np.ndarray]
    #: Class limit -> (sorted values, their items); limit 0 holds all shingles of short items.
    classes: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    present: np.ndarray | None = None

    def __post_init__(self) -> None:
        found: dict[int, list[tuple[int, int]]] = {}
        for i, h in enumerate(self.shingles):
            if 0 < len(h) <= SHORT:
                found.setdefault(0, []).extend((int(v), i) for v in h)
            elif len(h):
                limit = _bins(len(h))
                bins = h >> U64(64 - (4 * limit - 1).bit_length())
                # Sorted hashes: the first of each bin is its smallest.
                first = np.flatnonzero(np.diff(bins.astype(np.int64), prepend=-1))
                found.setdefault(limit, []).extend((int(v), i) for v in h[first])
        self.present = np.zeros(int(_BITS) + 1, bool)
        for limit, pairs in found.items():
            pairs.sort()
            values = np.array([v for v, _ in pairs], U64)
            self.classes[limit] = values, np.array([i for _, i in pairs])
            self.present[values & _BITS] = True


def _candidates(hashes: np.ndarray, at: np.ndarray, index: ItemIndex) -> set[int]:
    """Items of which a bin agrees with that of a window; ``at``: places that may hold a value."""
    out: set[int] = set()
    for limit, (values, items) in index.classes.items():
        lo = np.searchsorted(values, hashes[at], "left")
        hi = np.searchsorted(values, hashes[at], "right")
        if not limit:
            for a, b in set(zip(lo[hi > lo].tolist(), hi[hi > lo].tolist())):
                out.update(items[a:b].tolist())
            continue
        shift = U64(64 - (4 * limit - 1).bit_length())
        for place, a, b in zip(at[hi > lo], lo[hi > lo], hi[hi > lo]):
            new = set(items[a:b].tolist()) - out
            if not new:
                continue
            value = hashes[place]
            for start in {max(0, (place // limit - 1) * limit), place // limit * limit}:
                window = hashes[start : start + 2 * limit]
                if not ((window >> shift == value >> shift) & (window < value)).any():
                    out |= new
                    break
    return out


def _matches(part: pa.RecordBatch, index: ItemIndex, percent: int) -> Iterator[tuple[int, int, int]]:
    """(row, item, shared shingles) of each contained item."""
    words, at = word_hashes(part.column("text"), lower=True)
    grams = ngrams(words, 5)
    hits = np.flatnonzero(index.present[grams & _BITS])
    for row in range(part.num_rows):
        lo, hi = at[row], at[row + 1]
        if hi - lo >= 5:
            hashes = grams[lo : hi - 4]
            places = hits[np.searchsorted(hits, lo) : np.searchsorted(hits, hi - 4)] - lo
        else:
            hashes = shingle_set(words[lo:hi])
            places = np.arange(len(hashes))
        if not len(places):
            continue
        whole = None
        for item in sorted(_candidates(hashes, places, index)):
            whole = np.unique(hashes) if whole is None else whole
            shared = int(np.isin(index.shingles[item], whole, assume_unique=True).sum())
            if 100 * shared >= percent * len(index.shingles[item]):
                yield row, item, shared


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, at = word_hashes(batch.column("text"), lower=True)
        sets = [shingle_set(words[a:b]) for a, b in zip(at[:-1], at[1:])]
        yield pa.record_batch({"item_id": batch.column("item_id"), "shingles": pa.array([x.tobytes() for x in sets], pa.binary()), "n": pa.array([len(x) for x in sets], pa.int64())})


def item_blocks(items: DataFrame, block_shingles: int = BLOCK_SHINGLES) -> Iterator[ItemIndex]:
    """Indexes of all ``items`` (item_id, text), each of a bounded number of shingles."""
    sets = staged(
        items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_item_shingles, "item_id long, shingles binary, n long")
        .filter("n > 0"),
        "items",
    )
    ids, shingles, size = [], [], 0
    for row in sets.toLocalIterator():
        ids.append(row["item_id"])
        shingles.append(np.frombuffer(row["shingles"], "<u8").astype(U64))
        size += row["n"]
        if size >= block_shingles:
            yield ItemIndex(ids, shingles)
            ids, shingles, size = [], [], 0
    if ids:
        yield ItemIndex(ids, shingles)


def contained_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment) of each item found in a document."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, shared long, item_shingles long, containment double"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = spark.createDataFrame([], schema)
    for index in item_blocks(items, block_shingles):
        sent = spark.sparkContext.broadcast((index.ids, index.shingles))
        found = found.union(staged(texts.mapInArrow(_reporter(sent, percent), schema), "contained"))
        sent.destroy()
    return found


def _reporter(sent, percent: int):
    def task(batches):
        index = ItemIndex(*sent.value)
        for batch in batches:
            for part in parts(batch, "text"):
                ids = part.column("doc_id").to_pylist()
                rows = [(ids[r], index.ids[i], s, len(index.shingles[i]), s / len(index.shingles[i])) for r, i, s in _matches(part, index, percent)]
                if rows:
                    yield pa.record_batch(
                        [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.float64()])],
                        ["doc_id", "item_id", "shared", "item_shingles", "containment"],
                    )

    return task


def decontaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The rows of ``docs`` that contain no item, in place and with all their columns."""
    names, sent = docs.columns, None
    # Python functions over frames take no names with dots.
    docs = docs.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(names)])
    for index in item_blocks(items, block_shingles):
        if sent is not None:
            docs = staged(docs, "decontaminated")
            sent.destroy()
        sent = docs.sparkSession.sparkContext.broadcast((index.ids, index.shingles))
        docs = docs.mapInArrow(_remover(sent, percent), docs.schema)
    return docs.toDF(*names)


def _remover(sent, percent: int):
    def task(batches):
        index = ItemIndex(*sent.value)
        for batch in batches:
            for part in parts(batch, "text"):
                stays = np.ones(part.num_rows, bool)
                stays[[row for row, _, _ in _matches(part, index, percent)]] = False
                yield part.filter(pa.array(stays))

    return task
