"""Language identification by multilingual mixtures.

Each language is a distribution over hashed byte trigrams of lower-cased letters, learned from all
labelled texts. A document is a mixture: expectation-maximisation estimates its proportions, and the
set of languages is the one of the k largest proportions, k chosen by likelihood less
``penalty`` * log(trigrams) for each language beyond the first, up to all learned languages. A larger
k is not tried only where it cannot win: the likelihood is concave, so its gradient bounds what any
mixture reaches. The documents of an Arrow slice go
through the rounds together; memory follows the slice, not the table.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is everything when
no text is labelled; a null label teaches nothing; a null doc_id is never learned from by the query;
repeated rows count repeatedly; ties go to the language that is first by code point; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollwise.llm.words import U64, parts, utf8

#: Trigrams share this many classes; the model has this many numbers per language.
CLASSES = 1 << 15
SMOOTHING = 0.5
PENALTY = 2.0
ROUNDS = 12
UNKNOWN = "und"
#: Bytes of text that a task handles at once; with a model, divided by its languages. Arrays of numbers
#: take some 50 times as much, next to the executor's heap.
SLICE = 1 << 18
SLICE_OF_ALL = 1 << 20

_LETTER = re.compile(r"[^\W\d_]")
_BYTES = np.full(256, 0x20, np.uint8)
_BYTES[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_BYTES[0x80:] = np.arange(0x80, 0x100)


@dataclass
class Model:
    languages: list[str]
    #: Probability of each class in each language.
    probability: np.ndarray


def _trigrams(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each (text, class) present: the class and its count; for each text: its first entry and
    its number of trigrams. Only texts with a trigram around a letter have entries."""
    data, offsets = utf8(pc.utf8_lower(pc.cast(pc.fill_null(texts, ""), pa.large_string())))
    b = np.concatenate(([0x20], _BYTES[data], [0x20])).astype(np.uint8)
    middle = np.flatnonzero(b[1:-1] != 0x20)
    owner = np.searchsorted(offsets, middle, "right") - 1
    before = np.where(middle > offsets[owner], b[middle], 0x20).astype(U64)
    after = np.where(middle + 1 < offsets[owner + 1], b[middle + 2], 0x20).astype(U64)
    code = (before << U64(16)) | (b[middle + 1].astype(U64) << U64(8)) | after
    code = ((code * U64(0x9E3779B97F4A7C15)) >> U64(40)) % U64(width)
    key = owner.astype(np.int64) * width + code.astype(np.int64)
    key, count = np.unique(key, return_counts=True)
    owner = key // width
    return key % width, count, owner, np.bincount(owner, count, len(texts))


def _learn(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    seen: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in parts(batch, "text", SLICE):
            classes, count, owner, _ = _trigrams(part.column("text"), width)
            labels = np.array(part.column("lang").to_pylist(), object)
            for lang in set(labels.tolist()):
                mine = (labels == lang)[owner]
                seen.setdefault(lang, np.zeros(width, np.int64))
                seen[lang] += np.bincount(classes[mine], count[mine], width).astype(np.int64)
    for lang, counts in seen.items():
        present = np.flatnonzero(counts)
        yield pa.record_batch({"lang": pa.array([lang] * len(present), pa.string()), "class": pa.array(present), "n": pa.array(counts[present])})


def learn(labelled: DataFrame, width: int = CLASSES) -> Model:
    """A model from all rows of ``labelled`` (text, lang); rows without lang are left out."""

    def task(batches):
        yield from _learn(batches, width)

    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    # At most ``width`` rows for each language, whatever the corpus.
    found = rows.mapInArrow(task, "lang string, class long, n long").groupBy("lang", "class").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((width, len(languages)))
    for i, lang in enumerate(languages):
        mine = found[found["lang"] == lang]
        counts[mine["class"].to_numpy(), i] = mine["n"].to_numpy()
    return Model(languages, ((counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * width)).astype(np.float32))


def _fit(p: np.ndarray, count: np.ndarray, doc: np.ndarray, start: np.ndarray, total: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """EM rounds from ``share`` on (languages with share 0 stay out), and the log-likelihoods."""
    for _ in range(rounds):
        weight = p * share[doc]
        weight *= (count / weight.sum(1))[:, None]
        share = np.add.reduceat(weight, start) / total[:, None]
    return share, np.add.reduceat(count * np.log((p * share[doc]).sum(1)), start)


def mixture(texts: pa.Array, model: Model, penalty: float = PENALTY) -> np.ndarray:
    """Share of each language in each text, 0 outside the chosen set; all 0 without a trigram."""
    classes, count, owner, total = _trigrams(texts, len(model.probability))
    languages = len(model.languages)
    shares = np.zeros((len(texts), languages))
    if not len(classes) or not languages:
        return shares
    full = np.flatnonzero(total > 0)
    start = np.flatnonzero(np.diff(owner, prepend=-1))
    doc = np.cumsum(np.diff(owner, prepend=owner[0]) > 0)
    p, count, total = model.probability[classes], count.astype(np.float32), total[full].astype(np.float32)
    share = np.full((len(full), languages), 1 / languages, np.float32)
    share, value = _fit(p, count, doc, start, total, share, ROUNDS)
    gradient = np.add.reduceat(p * (count / (p * share[doc]).sum(1))[:, None], start) / total[:, None]
    # No mixture is likelier than this; the last term is for the rounding of single precision.
    bound = value + total * (gradient.max(1) - 1) + 1e-5 * np.abs(value)
    rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1)
    best, chosen = np.full(len(full), -np.inf), np.zeros_like(share)
    left = np.arange(len(full))
    for k in range(1, languages + 1):
        open_ = bound[left] - penalty * (k - 1) * np.log(total[left]) > best[left]
        if not open_.any():
            break
        if not open_.all():
            left, entries = left[open_], open_[doc]
            p, count, doc = p[entries], count[entries], (np.cumsum(open_) - 1)[doc[entries]]
            start = np.flatnonzero(np.diff(doc, prepend=-1))
        inside = np.where(rank[left] < k, np.maximum(share[left], 1e-6), 0).astype(np.float32)
        fitted, value = _fit(p, count, doc, start, total[left], inside / inside.sum(1, keepdims=True), 0 if k == 1 else ROUNDS)
        value = value - penalty * (k - 1) * np.log(total[left])
        better = value > best[left]
        best[left[better]], chosen[left[better]] = value[better], fitted[better]
    shares[full] = chosen
    return shares


def _predict(batches: Iterator[pa.RecordBatch], model: Model, keep_text: bool = False) -> Iterator[pa.RecordBatch]:
    size = max(1 << 16, SLICE_OF_ALL // max(1, len(model.languages)))
    for batch in batches:
        kept = [c for c in batch.schema.names if keep_text or c != "text"]
        for part in parts(batch, "text", size):
            shares = mixture(part.column("text"), model)
            letters = np.array([bool(t and _LETTER.search(t)) for t in part.column("text").to_pylist()])
            known = letters & bool(model.languages)
            top = shares.argmax(1) if model.languages else np.zeros(len(letters), int)
            pred = [model.languages[t] if k else UNKNOWN for t, k in zip(top, known)]
            score = [float(min(1.0, s[t])) if k else 0.0 for s, t, k in zip(shares, top, known)]
            sets = [{model.languages[i]: float(s[i]) for i in np.flatnonzero(s)} if k else {} for s, k in zip(shares, known)]
            yield pa.record_batch(
                [*(part.column(c) for c in kept), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array([list(x.items()) for x in sets], pa.map_(pa.string(), pa.float64()))],
                [*kept, "lang_pred", "score", "lang_shares"],
            )


def identify(docs: DataFrame, model: Model, keep_text: bool = False) -> DataFrame:
    """lang_pred, score (its share) and lang_shares for each row of ``docs``, in place of ``text`` or beside it."""
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.probability))

    def task(batches):
        yield from _predict(batches, Model(*sent.value), keep_text)

    kept = [f for f in docs.schema.fields if keep_text or f.name != "text"]
    added = T.StructType.fromDDL("lang_pred string, score double, lang_shares map<string, double>")
    return docs.mapInArrow(task, T.StructType([*kept, *added.fields]))


def held_out(key: str = "doc_id") -> Column:
    """Every fifth document by the checksum of its key; a null key is held out."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learn_and_identify(docs: DataFrame, width: int = CLASSES) -> DataFrame:
    """doc_id, held_out, lang_pred, score, lang_shares of all ``docs`` (doc_id, text, lang)."""
    model = learn(docs.filter(~held_out()).select("text", "lang"), width)
    return identify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text")), model)
