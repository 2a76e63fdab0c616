"""Packing tokenized documents into sequences by vector best fit.

A document is its token ids and an end id; only one longer than a sequence is cut into pieces. A
sequence is a bin with three capacities: tokens, pieces (documents) and attention cost, the sum of
squared piece lengths. Pieces go in order of falling length, each into the bin that fits it under
every constraint and is best by the weighted norm of what would be left (``norm``) or by the weighted
dot product of the piece with what the bin has left (``dot``); a new bin is opened only where none fits.

A piece is to the packer what its length is, and bins with the same remainder are alike. So the
packer works on numbers of pieces per length, which are at most as many as a sequence has tokens, and
moves whole ranges of pieces into whole ranges of bins: the same bins that taking the pieces one by
one would choose, in steps that do not depend on the number of documents. The driver holds these
counts and the placements, nothing else. Tasks tokenize, and afterwards give the r-th piece of a
length its sequence and place. r comes from two levels: the place among the pieces of that length in
the task, and the number of them in earlier tasks, so no task meets all pieces of a frequent length.

Words are tokenized once where they repeat: text is split at ASCII white space or finer, so the
tokenizer must not join tokens across it (word-level pre-tokenizers that drop white space do not).

Defined cases: a null text is empty and has the end id alone; repeated rows and null doc_ids are
packed as documents of their own; ties between bins go to the smaller remainder; a piece that alone
exceeds a capacity is an error; no documents give no rows; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollwise.llm.staging import staged
from rollwise.llm.words import parts

CAPACITY = 4096
END_ID = 1
#: Tokens, pieces and attention cost; a full sequence of one document costs as much as it has tokens.
WEIGHTS = (1.0, 0.05, 0.05)
_CACHE = 1 << 19
#: Pieces that go to the tokenizer in one call, which holds much beside their ids.
_AT_ONCE = 1 << 13
_PIECE = 1 << 22


@dataclass(frozen=True)
class Bin:
    """What a sequence may hold."""

    tokens: int = CAPACITY
    pieces: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = WEIGHTS
    select: str = "norm"

    @property
    def capacities(self) -> tuple[int, int, int]:
        """Pieces and cost default to what the tokens allow at most."""
        return self.tokens, self.pieces or self.tokens, self.cost or self.tokens**2


class _Open:
    """Bins that can still take something, as ranges of bins by equal remainder."""

    def __init__(self, of: Bin):
        self.of = of
        self.whole = np.array(of.capacities, np.float64)
        self.weights = np.array(of.weights)
        self.left = np.zeros((64, 3), np.int64)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in self.left]
        self.at: dict[tuple, int] = {}
        self.free = list(range(len(self.left)))

    def add(self, left: tuple, first: int, bins: int) -> None:
        if min(left) < 1:
            return
        if left not in self.at:
            if not self.free:
                n = len(self.left)
                self.left = np.concatenate((self.left, np.zeros_like(self.left)))
                self.ranges += [[] for _ in range(n)]
                self.free = list(range(n, 2 * n))
            self.at[left] = self.free.pop()
            self.left[self.at[left]] = left
        self.ranges[self.at[left]].append((first, bins))

    def best(self, need: np.ndarray) -> int | None:
        """The slot of the best bins for a piece, None where nothing fits; empty slots have nothing left."""
        fits = np.flatnonzero((self.left >= need).all(1))
        if not len(fits):
            return None
        left, need = self.left[fits] / self.whole, need / self.whole
        score = ((left - need) ** 2) @ self.weights if self.of.select == "norm" else -(left * need) @ self.weights
        ties = fits[score == score.min()]
        return int(min(ties, key=lambda i: tuple(self.left[i])))

    def take(self, slot: int) -> tuple[tuple, int, int]:
        left = tuple(self.left[slot].tolist())
        first, bins = self.ranges[slot].pop()
        if not self.ranges[slot]:
            self.left[slot] = 0
            del self.at[left]
            self.free.append(slot)
        return left, first, bins


def placements(counts: dict[int, int], of: Bin) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, pieces per bin, first bin, offset) of each range of pieces, by length and rank.

    ``counts`` maps a length to its number of pieces. Pieces of a range fill one bin after the other.
    """
    opened, bins, out = _Open(of), 0, []
    for length in sorted(counts, reverse=True):
        need, rank, n = np.array((length, 1, length * length), np.int64), 0, counts[length]
        if (need > opened.whole).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while n:
            slot = opened.best(need)
            if slot is None:
                left, first, there = of.capacities, bins, n
            else:
                left, first, there = opened.take(slot)
            # A new bin is the only one that fits, and under the norm a bin stays the best one, until it is
            # full; under the dot product the next piece goes to an equal bin.
            each = 1 if of.select == "dot" and slot is not None else min(x // y for x, y in zip(left, need.tolist()))
            used, each = (min(there, n // each), each) if n >= each else (1, n)
            if slot is None:
                bins += used
            elif there > used:
                opened.add(left, first + used, there - used)
            out.append((length, rank, each, first, of.tokens - left[0]))
            opened.add(tuple(x - each * y for x, y in zip(left, need.tolist())), first, used)
            rank, n = rank + used * each, n - used * each
    return sorted(out)


# The rules of tokenizers that lower the case and split words by kind of character.
_WORD_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts of these characters are split alike by Python's classes, and are in normal form.
_PLAIN = re.compile("[\t-\r\x20-~\u00a1\u00a7\u00a9\u00ab\u00ae\u00b0\u00b6\u00b7\u00bb\u00bf\u00c0-\u012f\u0131-\u017f\u2010-\u2015\u2018-\u201f\u2026]*")
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|[^\sa-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+")


class _Numbered(dict):
    """Numbers keys in the order in which they are first asked for; ``new`` has those since it was emptied."""

    def __init__(self):
        self.new = []

    def __missing__(self, key):
        self[key] = n = len(self)
        self.new.append(key)
        return n


def _words(path: str) -> _Words:
    """The tokenizer at ``path``, loaded once in a Python worker, which serves many tasks."""
    kept = vars(sys.modules.setdefault("rollwise_kept", ModuleType("rollwise_kept")))
    if path not in kept:
        kept[path] = _Words(path)
    return kept[path]


class _Words:
    """Token ids of texts. What a text consists of is tokenized once, as it repeats.

    A text of plain characters is split as a word-level tokenizer splits it, if the given one is of
    that kind, and its pieces go to the tokenizer's model; any other text is split at ASCII white space
    and its words go to the whole tokenizer.
    """

    def __init__(self, path: str):
        # Tasks run side by side already.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        normal, split = (json.loads(x.__getstate__()) if x else {} for x in (self.whole.normalizer, self.whole.pre_tokenizer))
        steps = [x["type"] for x in normal.get("normalizers", [])]
        patterns = [x.get("pattern", {}).get("Regex") for x in split.get("pretokenizers", [])]
        added = self.whole.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(re.escape(x.content) for x in added) or "(?!)")
        self.model, suffix = None, getattr(self.whole.model, "end_of_word_suffix", None)
        if steps == _WORD_NORMALIZER and patterns == [_WORD_PATTERN, None] and suffix:
            self.model = Tokenizer(self.whole.model)
            split = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            self.model.pre_tokenizer = pre_tokenizers.Sequence(split)
            vocabulary = self.whole.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[n for token, n in vocabulary.items() if token.endswith(suffix)]] = True
        self._clear()

    def _clear(self) -> None:
        """Numbers of pieces and of words; the ids of number n are ids[starts[n] : starts[n + 1]], by kind."""
        self.numbers = (_Numbered(), _Numbered())
        self.starts = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.known = [np.zeros(0, np.uint32), np.zeros(0, np.uint32)]

    def _encoded(self, kind: int, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some pieces or words one after the other, and how many each has."""
        if kind == 0:
            # In one go: every piece ends with the one token that has the suffix of word ends.
            flat = np.array(self.model.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends[flat])
            if len(ends) != len(new):
                raise ValueError("the tokenizer does not end every piece with its suffix")
            return flat, np.diff(ends, prepend=-1)
        found = [e.ids for e in self.whole.encode_batch_fast(new, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _learn(self, kind: int) -> None:
        new, starts, known = self.numbers[kind].new, [self.starts[kind]], [self.known[kind]]
        for lo in range(0, len(new), _AT_ONCE):
            ids, sizes = self._encoded(kind, new[lo : lo + _AT_ONCE])
            starts.append(starts[-1][-1] + np.cumsum(sizes))
            known.append(ids)
        self.starts[kind], self.known[kind] = np.concatenate(starts), np.concatenate(known)
        new.clear()

    def _stretches(self, text: str) -> Iterator[str]:
        """A text a few megabytes at a time, cut at white space."""
        pos = 0
        while pos < len(text):
            cut = _BLANK.search(text, pos + _PIECE)
            end = cut.start() if cut else len(text)
            yield text[pos:end]
            pos = end

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if max(map(len, self.numbers)) > _CACHE:
            self._clear()
        split = []
        for text in texts:
            plain = self.model is not None and _PLAIN.fullmatch(text) and not self.special.search(text)
            kind, number = (0, self.numbers[0].__getitem__) if plain else (1, self.numbers[1].__getitem__)
            found = [np.zeros(0, np.int64)]
            for stretch in self._stretches(text):
                pieces = _SPLIT.findall(stretch.lower()) if plain else _CHUNK.findall(stretch)
                found.append(np.fromiter(map(number, pieces), np.int64, len(pieces)))
            split.append((kind, np.concatenate(found)))
        out: list = [None] * len(texts)
        for kind in (0, 1):
            self._learn(kind)
            own = [i for i, (k, _) in enumerate(split) if k == kind]
            if not own:
                continue
            numbers = np.concatenate([split[i][1] for i in own])
            starts = self.starts[kind]
            sizes = starts[numbers + 1] - starts[numbers]
            ends = np.cumsum(sizes)
            flat = self.known[kind][np.repeat(starts[numbers] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
            upto = np.concatenate(([0], ends))[np.cumsum([len(split[i][1]) for i in own])]
            for i, lo, hi in zip(own, np.concatenate(([0], upto[:-1])), upto):
                out[i] = flat[lo:hi]
        return out


_BLANK = re.compile(r"[\x20\x09-\x0D]")
_CHUNK = re.compile(r"[^\x20\x09-\x0D]+")
_NAMES = ["piece", "start", "length", "ids_crc32", "ids", "task", "nth"]
_PIECES = "piece int, start long, length long, ids_crc32 long, ids binary, task long, nth long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = True) -> DataFrame:
    """The pieces of each row of ``docs`` (doc_id, text): place in the document, length, CRC-32 of the
    little-endian 32-bit ids and (with ``ids``) the ids, with the task and the piece's number of its length there."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def cut(batches):
        words, task, numbers = _words(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in parts(batch, "text", 1 << 20):
                rows = []
                for i, found in enumerate(words.ids([x or "" for x in part.column("text").to_pylist()])):
                    whole = np.append(found, np.uint32(end_id)).astype("<u4")
                    for piece, lo in enumerate(range(0, len(whole), capacity)):
                        own = whole[lo : lo + capacity]
                        data = own.tobytes()
                        rows.append((i, piece, lo, len(own), zlib.crc32(data), data if ids else None, task, int(numbers[len(own)])))
                        numbers[len(own)] += 1
                columns = list(zip(*rows)) or [()] * 8
                types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
                arrays = [pa.array(c, t) for c, t in zip(columns[1:], types)]
                doc_ids = part.column("doc_id").take(pa.array(columns[0], pa.int64()))
                yield pa.record_batch([doc_ids, *arrays], ["doc_id", *_NAMES])

    return docs.mapInArrow(cut, T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(_PIECES).fields]))


def packed(docs: DataFrame, tokenizer: str, of: Bin = Bin(), end_id: int = END_ID, ids: bool = True) -> DataFrame:
    """The pieces of ``docs`` with the ``sequence_id`` each goes to and its ``offset`` there."""
    pieces = staged(token_pieces(docs, tokenizer, of.tokens, end_id, ids), "pieces")
    counts = staged(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    # At most one row per length that a sequence can have.
    total = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = np.array(placements(total, of), np.int64).reshape(-1, 5)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "task"]).withColumn("rank", F.col("before") + F.col("nth"))
    shift = np.int64(62 - int(of.tokens).bit_length())
    keys = (plan[:, 0] << shift) + plan[:, 1]

    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = plan[np.searchsorted(keys, (length << shift) + rank, "right") - 1]
            nth, each = rank - row[:, 1], row[:, 2]
            sequence, offset = row[:, 3] + nth // each, row[:, 4] + nth % each * length
            yield pa.record_batch([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    kept = [c for c in pieces.columns if c not in ("task", "nth") and (ids or c != "ids")]
    tail = T.StructType.fromDDL("sequence_id long, offset long")
    return ranked.select(*kept, "rank").mapInArrow(place, T.StructType([*(pieces.schema[c] for c in kept), *tail.fields]))


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, its token ids (binary, little-endian 32-bit) and the offsets its pieces start at."""
    own = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id", "piece")))  # no more than a sequence holds
    whole = pieces.groupBy("sequence_id").agg(own.alias("own"))
    joined = F.aggregate("own", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return whole.select("sequence_id", joined.alias("ids"), F.col("own.offset").alias("offsets"), F.col("own.doc_id").alias("doc_ids"))
