"""Exact deduplication by Grace hashing.

Texts that are equal after white space runs become one space form a group. Records are dealt to
partitions by the SHA-256 of the normalised text. A partition fills an open-addressing table that
compares complete contents; when the table outgrows its limit, the partition's records go to spill
files by the next four bits of the hash, and each file is handled alike until it fits. Equal records
are merged in a table of their own before they are dealt, so a text that a third of all rows share
arrives as one record per task, and merged records never overfill a table.

Only (text, smallest doc_id, count) meet in a partition. Members find their group by a join on the
hash, which Spark splits where one group is hot.

Defined cases: null counts as the empty text; rows without doc_id count in group_size, and keep_id
is null where no member has one; rows that repeat both doc_id and text are all kept or all dropped;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of distinct texts a table may hold before it spills.
TABLE_BYTES = 32 << 20
_FAN_OUT_BITS = 4
_DEPTH = 60 // _FAN_OUT_BITS

Record = tuple[bytes, bytes, int | None, int]


class ContentTable:
    """Open addressing with linear probing; a slot holds [hash, content, smallest id, count]."""

    def __init__(self) -> None:
        self.slots: list[list | None] = [None] * 64
        self.used = 0
        self.bytes = 0

    def _slot(self, digest: bytes, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[8:16]) & mask
        while (held := self.slots[at]) is not None and not (held[0] == digest and held[1] == content):
            at = (at + 1) & mask
        return at

    def add(self, record: Record) -> None:
        digest, content, low, count = record
        at = self._slot(digest, content)
        if (held := self.slots[at]) is not None:
            held[3] += count
            if low is not None and (held[2] is None or low < held[2]):
                held[2] = low
            return
        self.slots[at] = [digest, content, low, count]
        self.used += 1
        self.bytes += len(content) + 200
        if 3 * self.used > 2 * len(self.slots):
            old = [x for x in self.slots if x is not None]
            self.slots = [None] * (2 * len(self.slots))
            for x in old:
                self.slots[self._slot(x[0], x[1])] = x

    def records(self) -> Iterator[Record]:
        return (tuple(x) for x in self.slots if x is not None)


def _read(path: str) -> Iterator[Record]:
    with open(path, "rb") as file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def grace_merge(records: Iterable[Record], limit: int = TABLE_BYTES, depth: int = 0) -> Iterator[Record]:
    """Merge records of equal content, with one table in memory and spill files of this task's own."""
    table, files = ContentTable(), None
    with tempfile.TemporaryDirectory() as folder:
        paths = [os.path.join(folder, str(i)) for i in range(1 << _FAN_OUT_BITS)]

        def spill(record: Record) -> None:
            bits = int.from_bytes(record[0][:8]) >> (60 - _FAN_OUT_BITS * depth) & ((1 << _FAN_OUT_BITS) - 1)
            pickle.dump(record, files[bits])

        for record in records:
            if files is not None:
                spill(record)
                continue
            table.add(record)
            if table.bytes > limit and table.used > 1 and depth < _DEPTH:
                files = [open(p, "wb") for p in paths]
                for held in table.records():
                    spill(held)
                table = ContentTable()
        if files is None:
            yield from table.records()
            return
        for file in files:
            file.close()
        for path in paths:
            yield from grace_merge(_read(path), limit, depth + 1)
            os.remove(path)


_RECORD = "digest binary, content binary, low long, n long"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[Record]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(batch.column(c)[i].as_py() for c in range(4))


def _partial(records: Iterable[Record], limit: int) -> Iterator[Record]:
    """Merge what fits the table at one time; equal records may remain."""
    table = ContentTable()
    for record in records:
        table.add(record)
        if table.bytes > limit:
            yield from table.records()
            table = ContentTable()
    yield from table.records()


def _batches(records: Iterable[Record], limit: int, contents: bool) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for record in records:
        rows.append(record)
        size += len(record[1])
        if size > limit // 4 or len(rows) >= 4096:
            yield _batch(rows, contents)
            rows, size = [], 0
    if rows:
        yield _batch(rows, contents)


def _batch(rows: list[Record], contents: bool) -> pa.RecordBatch:
    digest, content, low, n = zip(*rows)
    columns = {"digest": pa.array(digest, pa.binary())} | ({"content": pa.array(content, pa.binary())} if contents else {})
    return pa.record_batch(columns | {"low": pa.array(low, pa.int64()), "n": pa.array(n, pa.int64())})


def normalised(text: str = "text") -> Column:
    """White space runs as one space, null as empty."""
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per group of equal texts: digest (SHA-256), keep_id, group_size."""

    def local(batches):
        yield from _batches(_partial(_records(batches), table_bytes), table_bytes, True)

    def final(batches):
        yield from _batches(grace_merge(_records(batches), table_bytes), table_bytes, False)

    content = docs.select(F.encode(normalised(), "UTF-8").alias("content"), F.col("doc_id").cast("long").alias("low"))
    records = content.select(F.unhex(F.sha2("content", 256)).alias("digest"), "content", "low", F.lit(1).cast("long").alias("n"))
    dealt = records.mapInArrow(local, _RECORD).repartition("digest")
    return dealt.mapInArrow(final, "digest binary, low long, n long").toDF("digest", "keep_id", "group_size")


def exact_dedup(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs`` (doc_id, text)."""
    members = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(normalised(), 256)).alias("digest"))
    return members.join(exact_groups(docs, table_bytes), "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )
