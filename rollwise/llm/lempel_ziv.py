"""Substring deduplication by relative Lempel-Ziv parsing.

A window is 50 consecutive words. Words covered by a window that also starts in a document with a
smaller doc_id are removed. Steps:

1. *Index.* Every window is anchored at the smallest of its 8-word grams, so equal windows have equal
   anchors; one word in about twenty is an anchor. For each gram that several documents have, its
   first occurrence (smallest doc_id, then place) is the reference. Text around references is held
   in blocks of ``BLOCK`` words, so what is joined to a document has a bounded size however long the
   reference document is.
2. *Parsing.* A document meets each reference block that its anchors name. From each anchor the match
   with the block is extended both ways as far as it goes; anchors inside a factor already found are
   skipped. Factors of 50 words or more are duplicate spans.
3. *Factor boundaries.* A window that crosses the end of a factor may still occur in another document
   than the reference, which then leaves that window open too. An anchor sends its open windows once, as
   hashes: 42 + 1 at most for each of its two boundaries. They are summed up by hash to the smallest and
   largest document, in tasks first, so what a group of near copies has in common meets as one row.
4. *Removal.* Spans are joined with the texts by row.

A passage in a third of all documents gives each of them one reference, never pairs among them, and
the joins with the index and with reference blocks can be split by Spark. No join meets boundaries of
one document with those of another: every window is looked up once among those that several share.

Defined cases: null and blank texts have no words; documents without doc_id lose nothing and are no
reference; rows that repeat a doc_id do not count as smaller than each other; overlapping repeats
within a document stay; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwise.llm.staging import staged
from rollwise.llm.words import U64, mix, ngrams, parts, word_hashes

WINDOW = 50
GRAM = 8
BLOCK = 256
_REACH = WINDOW - GRAM
_PLACE = U64((1 << 24) - 1)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """gram, doc_id, row and place of each anchor; place holds the anchor's word, how far before it
    its first window starts, and how many windows it anchors."""
    for batch in batches:
        for part in parts(batch, "text"):
            words, at = word_hashes(part.column("text"))
            if len(words) < WINDOW:
                continue
            grams = ngrams(words, GRAM)
            # Words of one slice; only a text beyond 16 million words is cut into several stretches.
            for base in range(0, len(words), int(_PLACE) - WINDOW):
                piece = grams[base : base + int(_PLACE)]
                if len(piece) <= _REACH:
                    break
                key = (piece & ~_PLACE) | np.arange(len(piece), dtype=U64)
                smallest = (_sliding_min(key, _REACH + 1) & _PLACE).astype(np.int64) + base
                start = np.arange(len(smallest)) + base
                keep = start < base + int(_PLACE) - WINDOW
                owner = np.searchsorted(at, start, "right") - 1
                keep &= start + WINDOW <= at[owner + 1]
                start, smallest, owner = start[keep], smallest[keep], owner[keep]
                if not len(start):
                    continue
                run = np.flatnonzero((np.diff(smallest, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
                size = np.diff(np.append(run, len(start)))
                anchor, who = smallest[run], owner[run]
                place = (anchor - at[who] << 12) | (anchor - start[run] << 6) | size
                yield pa.record_batch(
                    [pa.array(grams[anchor].view(np.int64)), part.column("doc_id").take(pa.array(who)), part.column("row").take(pa.array(who)), pa.array(place)],
                    ["gram", "doc_id", "row", "place"],
                )


def _unplace(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 12, (place >> 12) - (place >> 6 & 63), place & 63


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reference blocks of a text, and for each block it refers to, its words around the anchors.

    Words are hashes. A segment is sent as its start, its length and its words.
    """
    for batch in batches:
        for part in parts(batch, "text", 1 << 20):
            words, at = word_hashes(part.column("text"))
            rows = []
            for i, row in enumerate(part.select(["row", "doc_id", "asks", "gives"]).to_pylist()):
                own = words[at[i] : at[i + 1]]
                for block in set(row["gives"] or ()):
                    lo = max(0, block * BLOCK - _REACH)
                    rows.append((row["row"], block, None, None, None, None, np.array([lo]).tobytes(), own[lo : (block + 1) * BLOCK + WINDOW].tobytes()))
                asked: dict[tuple, list] = {}
                for ask in row["asks"] or ():
                    asked.setdefault((ask["reference"], ask["other"] // BLOCK, ask["smaller"]), []).append((ask["place"], ask["other"]))
                for (reference, block, smaller), seeds in asked.items():
                    seeds = np.array(sorted(seeds), np.int64)
                    _, lo, n = _unplace(seeds[:, 0])
                    hi = np.maximum.accumulate(lo + n + WINDOW - 1)
                    new = np.concatenate(([True], lo[1:] > hi[:-1]))
                    starts, ends = lo[new], np.append(hi[:-1][new[1:]], hi[-1])
                    rows.append((reference, block, row["row"], row["doc_id"], smaller, seeds.tobytes(), np.concatenate((starts, ends)).tobytes(), b"".join(own[a:b].tobytes() for a, b in zip(starts, ends))))
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _SEGMENT_TYPES)], _SEGMENT_NAMES)


_SEGMENT_NAMES = ["reference", "block", "row", "doc_id", "smaller", "seeds", "cuts", "words"]
_SEGMENT_TYPES = [pa.int64()] * 4 + [pa.bool_()] + [pa.binary()] * 3
_SEGMENTS = "reference long, block long, row long, doc_id long, smaller boolean, seeds binary, cuts binary, words binary"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Factors of a document against one reference block, and the windows at their boundaries.

    kind 0: the factor [a, b). kind 1: the windows of an anchor that no factor covers (starts, hashes).
    """
    for batch in batches:
        rows = []
        for r in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "smaller", "seeds", "cuts", "words", "at", "block_words"))):
            row, doc, smaller, seeds, cuts, words, at, reference = r
            reference, base = np.frombuffer(reference, "<u8"), int(np.frombuffer(at, "<i8")[0])
            starts, ends = np.frombuffer(cuts, "<i8").reshape(2, -1)
            words = np.frombuffer(words, "<u8").astype(U64)
            offset = np.cumsum(ends - starts) - (ends - starts)
            seeds = np.frombuffer(seeds, "<i8").reshape(-1, 2)
            anchors, lows, counts = _unplace(seeds[:, 0])
            of = np.searchsorted(starts, lows, "right") - 1
            done: dict[int, int] = {}
            for anchor, low, count, other, segment in zip(anchors.tolist(), lows.tolist(), counts.tolist(), seeds[:, 1].tolist(), of.tolist()):
                shift = other - anchor
                if done.get(shift, -1) >= low + count + WINDOW - 1:
                    continue
                lo, hi = int(starts[segment]), int(ends[segment])
                own = words[offset[segment] : offset[segment] + hi - lo]
                first, last = max(lo, base - shift), min(hi, base + len(reference) - shift)
                differ = np.flatnonzero(own[first - lo : last - lo] != reference[first + shift - base : last + shift - base]) + first
                k = int(np.searchsorted(differ, anchor))
                begin = int(differ[k - 1]) + 1 if k else first
                end = int(differ[k]) if k < len(differ) else last
                if end - begin >= WINDOW:
                    if smaller:
                        rows.append((0, row, doc, begin, end, None, None))
                    if begin <= low:
                        done[shift] = max(done.get(shift, -1), end)
                open_ = [s for s in range(low, low + count) if s < begin or s + WINDOW > end]
                if open_:
                    hashes = ngrams(own[open_[0] - lo : open_[-1] + WINDOW - lo], WINDOW)
                    rows.append((1, row, doc, None, None, np.array(open_).tobytes(), hashes[np.array(open_) - open_[0]].tobytes()))
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _PARSED_TYPES)], _PARSED_NAMES)


_PARSED_NAMES = ["kind", "row", "doc_id", "a", "b", "starts", "hashes"]
_PARSED_TYPES = [pa.int32()] + [pa.int64()] * 4 + [pa.binary()] * 2
_PARSED = "kind int, row long, doc_id long, a long, b long, starts binary, hashes binary"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts = [np.frombuffer(x, "<i8") for x in batch.column("starts").to_pylist()]
        hashes = [np.frombuffer(x, "<i8") for x in batch.column("hashes").to_pylist()]
        if starts:
            who = pa.array(np.repeat(np.arange(len(starts)), [len(x) for x in starts]))
            yield pa.record_batch([batch.column("row").take(who), batch.column("doc_id").take(who), pa.array(np.concatenate(starts)), pa.array(np.concatenate(hashes))], ["row", "doc_id", "start", "hash"])


def _kept(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch, "text"):
            out = []
            for doc, text, spans in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                words = (text or "").encode().split()  # for bytes: exactly the white space of a word's definition
                gone = np.zeros(len(words), bool)
                for span in spans or ():
                    gone[span["a"] : span["b"]] = True
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if spans else words)
                out.append((doc, len(words), int(gone.sum()), kept.decode() if texts else hashlib.sha256(kept).hexdigest()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["doc_id", "n_words", "n_removed", "kept"])


def open_windows(parsed: DataFrame) -> DataFrame:
    """(row, doc_id, start, hash) of each window that crosses a boundary of its anchor's factor."""
    return parsed.filter("kind = 1").mapInArrow(_windows, "row long, doc_id long, start long, hash long")


def duplicate_spans(docs: DataFrame) -> DataFrame:
    """Word ranges [a, b) of each row (by its hash ``row``) of ``docs`` (row, doc_id, text)."""
    docs = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    anchors = staged(docs.mapInArrow(_anchors, "gram long, doc_id long, row long, place long"), "anchors")
    first = F.min(F.struct("doc_id", "place", "row"))
    index = anchors.groupBy("gram").agg(first.alias("first"), F.max("doc_id").alias("top")).filter("top > first.doc_id")
    # Written, so that the join has an exchange of its own and Spark can split the anchors of one gram.
    index = staged(index, "index")
    found = anchors.join(index.select("gram", "first"), "gram").filter("NOT (row = first.row AND place = first.place)")
    seeds = staged(found.select("row", "place", F.col("first.row").alias("reference"), F.shiftright(F.col("first.place"), 12).alias("other"), F.expr("first.doc_id < doc_id").alias("smaller")), "seeds")

    asks = seeds.groupBy("row").agg(F.collect_list(F.struct("place", "reference", "other", "smaller")).alias("asks"))
    gives = seeds.select(F.col("reference").alias("row"), F.floor(F.col("other") / BLOCK).alias("block")).distinct().groupBy("row").agg(F.collect_list("block").alias("gives"))
    needs = asks.join(gives, "row", "full")
    segments = staged(docs.join(needs, "row").mapInArrow(_segments, _SEGMENTS), "segments")
    blocks = segments.filter("row IS NULL").select("reference", "block", F.col("cuts").alias("at"), F.col("words").alias("block_words"))
    parsed = segments.filter("row IS NOT NULL").join(blocks, ["reference", "block"])
    parsed = staged(parsed.mapInArrow(_parse, _PARSED), "factors")

    windows = open_windows(parsed)
    earliest = windows.groupBy("hash").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    earliest = staged(earliest.select("hash", "lo"), "earliest")
    crossing = windows.join(earliest, "hash").filter("doc_id > lo").select("row", F.col("start").alias("a"), (F.col("start") + WINDOW).alias("b"))
    whole = parsed.filter("kind = 0").select("row", "a", "b")
    return whole.union(crossing)


def substring_dedup(docs: DataFrame, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words (or, with ``texts``, the kept
    words) of each row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    spans = duplicate_spans(docs).groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    def removed(batches):
        yield from _kept(batches, texts)

    name = "kept_text" if texts else "kept_sha256"
    return docs.join(spans, "row", "left").mapInArrow(removed, "doc_id long, n_words long, n_removed long, kept string").withColumnRenamed("kept", name)
