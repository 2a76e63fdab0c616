"""N-gram join, substring dedup, containment and exact dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from plain import components, shingles, without_repeats, words

from rollwise.llm.components import connected_components
from rollwise.llm.containment import ItemIndex, _matches, contained_items, decontaminated
from rollwise.llm.grace import ContentTable, exact_dedup, grace_merge
from rollwise.llm.jaccard_join import jaccard_join, link_counts
from rollwise.llm.lempel_ziv import substring_dedup
from rollwise.llm.words import ngrams, sequence_key, shingle_set, word_hashes

SCHEMA = "doc_id long, text string, source string, shared string, kept int"
CASES = [None, "", " \t\n", "one", "one two three", "One  TWO three", "a b c d e", "a b c d e f", "É é È", "x" * 200_000 + " y", "nul\x00 \x0b tab"]


def corpus(seed, groups=12, size=8, length=120):
    """Groups of edited copies, common passages, exact copies and odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    common = [rng.choices(vocabulary, k=60) for _ in range(2)]
    texts = list(CASES)
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(30, length))
        for _ in range(rng.randint(1, size)):
            copy = list(base)
            for _ in range(rng.randint(0, 9)):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([[], [rng.choice(vocabulary)], [copy[at], "new"]])
                copy = copy or ["left"]
            if rng.random() < 0.5:
                copy[rng.randrange(len(copy)) : 0] = rng.choice(common)[: rng.randint(45, 60)]
            texts.append(rng.choice([" ", "\n", "  "]).join(copy))
    texts += texts[:14] + [" ".join(common[0])] * 3
    rng.shuffle(texts)
    return texts


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "s", "x", 1) for d, t in rows], SCHEMA).repartition(3)


def test_word_hashes_follow_the_words():
    texts = [*CASES, *corpus(1)]
    hashes, at = word_hashes(pa.array(texts, pa.string()))
    seen = {}
    for i, text in enumerate(texts):
        own = words(text, lower=False)
        assert at[i + 1] - at[i] == len(own)
        for h, w in zip(hashes[at[i] : at[i + 1]].tolist(), own):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    sliced, cut = word_hashes(pa.array(texts, pa.string())[3:9])
    assert sliced.tolist() == hashes[at[3] : at[9]].tolist() and cut[-1] == len(sliced)
    assert len(ngrams(hashes[:4], 5)) == 0 and sequence_key(hashes[:0]) == bytes(16)


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    rng.shuffle(edges)
    found = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 120)} | {200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"block_shingles": 300, "bucket_bytes": 500, "summary": 20})])
def test_jaccard_join(spark, seed, options):
    texts = dict(enumerate(corpus(seed)))
    result, links = jaccard_join(frame(spark, [*texts.items(), (None, "a b c d e"), (3, texts[3])]), **options)
    rows = result.collect()
    assert result.columns == ["doc_id", "n_shingles", "component_id"]
    assert len(rows) == len(texts) + 2
    want = components(texts)
    for doc, n, component in rows:
        if doc is None:
            assert (n, component) == (1, None)
        else:
            assert (n, component) == (len(shingles(texts[doc])), want[doc]), doc
    for a, b in links.collect():
        x, y = shingles(texts[a]), shingles(texts[b])
        assert 100 * len(x & y) >= 75 * len(x | y)


def test_shingles_that_share_their_low_bits_stay_apart(spark, monkeypatch):
    """With hashes that differ in their upper half alone, sizes and links are still those of the texts."""
    from rollwise.llm import jaccard_join as module

    real = module.shingle_set
    monkeypatch.setattr(module, "shingle_set", lambda words: np.unique(real(words) & np.uint64(0xFFFFFFFF00000000)))
    texts = dict(enumerate(corpus(31)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join(frame(spark, list(texts.items())))[0].collect()}
    want = components(texts)
    assert got == {i: (len(shingles(t)), want[i]) for i, t in texts.items()}


def test_jaccard_join_of_one_wide_group(spark):
    """Copies that are near a common text but mostly not near each other."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    texts = {}
    for doc in range(150):
        copy = list(base)
        for at in rng.sample(range(150), rng.randint(1, 6)):
            copy[at] = rng.choice([f"x{doc}", "shared", ""])
        texts[doc] = " ".join(copy)
    result, _ = jaccard_join(frame(spark, texts.items()), block_shingles=5000)
    assert {r.doc_id: r.component_id for r in result.collect()} == components(texts)


@pytest.mark.parametrize("options", [{}, {"block_shingles": 300}])
def test_jaccard_join_returns_every_link(spark, options):
    rng = random.Random(6)
    base = [f"b{i}" for i in range(150)]
    texts = dict(enumerate(corpus(3)))
    for doc in range(1000, 1040):
        copy = list(base)
        for at in rng.sample(range(150), rng.randint(0, 6)):
            copy[at] = rng.choice([f"x{doc}", "shared"])
        texts[doc] = " ".join(copy)
    first = {}
    for doc in sorted(texts):
        first.setdefault(tuple(words(texts[doc])), doc)
    sets = {doc: shingles(texts[doc]) for doc in first.values()}
    want = {(a, b) for a in sets for b in sets if a > b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    given = frame(spark, [*texts.items(), (None, texts[1000]), (1001, texts[1001])])
    found = [tuple(r) for r in jaccard_join(given, **options)[1].collect()]
    assert len(found) == len(set(found)) and set(found) == want
    assert len(want) > 2 * len(set(sum(want, ())))
    count = {doc: sum(first[tuple(words(t))] in pair for pair in want) for doc, t in texts.items()}
    got = sorted(((r.doc_id, r.n_links) for r in link_counts(given, **options).collect()), key=str)
    assert got == sorted([*count.items(), (None, 0), (1001, count[1001])], key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substring_dedup(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(40)]
    passages = [rng.choices(vocabulary, k=rng.randint(40, 130)) for _ in range(8)]
    rows = []
    for doc in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            passage = rng.choice(passages)
            lo = rng.choice([0, 0, rng.randrange(len(passage))])
            parts += passage[lo : rng.choice([len(passage), rng.randint(lo, len(passage))])]
            parts += rng.choices(vocabulary, k=rng.choice([0, 1, 3, 30]))
        rows.append((doc, rng.choice([" ", "\n "]).join(parts)))
    rows += [(100, "r " * 400), (101, "r " * 49), (102, "r " * 50), (103, None), (104, ""), (None, rows[0][1]), (105, rows[5][1]), (105, rows[5][1])]
    long = " ".join(f"z{i}" for i in range(2000))
    rows += [(106, long), (107, f"head {long} tail"), (108, " ".join(long.split()[300:900]))]
    rng.shuffle(rows)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in substring_dedup(frame(spark, rows), texts=True).collect())
    want = sorted((str(d), len(w), len(w) - len(k), " ".join(k)) for d, w, k in without_repeats(rows))
    assert got == want
    digests = {r.kept_sha256 for r in substring_dedup(frame(spark, rows[:5])).collect()}
    assert digests == {hashlib.sha256(" ".join(k).encode()).hexdigest() for _, _, k in without_repeats(rows[:5])}


def test_short_items_are_never_missed():
    rng = random.Random(17)
    vocabulary = [f"u{i}" for i in range(4000)]
    items = [" ".join(rng.choices(vocabulary, k=5 + i % 10)) for i in range(2000)]
    texts = []
    for item in items:
        text = rng.choices(vocabulary, k=300)
        at = rng.randrange(300)
        texts.append(" ".join(text[:at] + item.split() + text[at:]))
    hashes, at = word_hashes(pa.array(items), lower=True)
    index = ItemIndex(list(range(len(items))), [shingle_set(hashes[a:b]) for a, b in zip(at[:-1], at[1:])])
    found = {(row, item) for row, item, _ in _matches(pa.record_batch({"text": pa.array(texts)}), index, 75)}
    assert {(i, i) for i in range(len(items))} <= found


def test_contained_items(spark):
    rng = random.Random(7)
    vocabulary = [f"u{i}" for i in range(5000)]
    items = {i: " ".join(rng.choices(vocabulary, k=rng.choice([5, 6, 9, 14, 37, 60, 200]))) for i in range(60)} | {90: None, 91: "", 92: "Three Word item", 93: None}
    docs = {}
    for doc in range(120):
        text = rng.choices(vocabulary, k=rng.choice([0, 5, 80, 2000]))
        for _ in range(rng.randint(0, 2)):
            item = words(items[rng.randrange(60)])
            keep = item[rng.randint(0, len(item) // 3) :]
            text[rng.randint(0, len(text)) : 0] = [w.upper() if w == "U1" else w for w in keep]
        docs[doc] = " ".join(text)
    docs |= {200: None, 201: "", 202: "three word ITEM", 203: "a three word item", 204: items[3].upper(), 205: (items[4] + " ") * 30}
    bench = spark.createDataFrame([(i, t, "x") for i, t in items.items()] + [(None, items[3], "x")], "item_id long, text string, shared string")
    want = {
        (d, i, len(shingles(t) & shingles(x)))
        for d, t in docs.items()
        for i, x in [*items.items(), (None, items[3])]
        if shingles(x) and 100 * len(shingles(t) & shingles(x)) >= 75 * len(shingles(x))
    }
    given = frame(spark, [*docs.items(), (None, items[5])])
    for options in ({}, {"block_shingles": 100}):
        found = {(r.doc_id, r.item_id, r.shared) for r in contained_items(given, bench, **options).collect()}
        assert {x for x in found if x[0] is not None} == want
        assert (None, 5, len(shingles(items[5]))) in found
        clean = decontaminated(given, bench, **options)
        assert clean.columns == given.columns
        assert {r.doc_id for r in clean.collect()} == set(docs) - {d for d, _, _ in want}
    assert contained_items(given, bench.limit(0)).count() == 0
    assert decontaminated(given.limit(0), bench).count() == 0


def test_grace_merge_spills_and_compares_contents():
    rng = random.Random(1)
    texts = [f"text {rng.randrange(400)} ".encode() * 20 for _ in range(3000)]
    records = [(hashlib.sha256(t).digest(), t, i if i % 3 else None, 1) for i, t in enumerate(texts)]
    # Two contents behind one digest stay apart.
    records += [(b"\0" * 32, b"left", 1, 1), (b"\0" * 32, b"right", 2, 1), (b"\0" * 32, b"left", 0, 1)]
    want = defaultdict(lambda: [None, 0])
    for _, content, low, n in records:
        held = want[content]
        held[1] += n
        held[0] = low if held[0] is None else held[0] if low is None else min(low, held[0])
    for limit in (1 << 30, 5000):
        merged = list(grace_merge(iter(records), limit))
        assert {c: [low, n] for _, c, low, n in merged} == dict(want) and len(merged) == len(want)
    assert list(grace_merge(iter([]), 10)) == [] and list(ContentTable().records()) == []


def test_exact_dedup(spark):
    rng = random.Random(2)
    rows = [(i, t) for i, t in enumerate(corpus(4) * 2)] + [(None, "a b c d e"), (0, "again"), (0, "again"), (500, "x\ty"), (501, "x \r\ny"), (502, " x y"), (503, "X y")]
    rows += [(1000 + i, "hot") for i in range(300)]
    rng.shuffle(rows)
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for doc, text in rows:
        groups[norm(text)].append(doc)
    want = []
    for doc, text in rows:
        own = groups[norm(text)]
        keep = min((d for d in own if d is not None), default=None)
        want.append((doc, keep, len(own), doc == keep, hashlib.sha256(norm(text).encode()).hexdigest()))
    for limit in (32 << 20, 2000):
        assert sorted(map(tuple, exact_dedup(frame(spark, rows), limit).collect()), key=str) == sorted(want, key=str)
    assert exact_dedup(frame(spark, rows).limit(0)).count() == 0


def test_empty_tables(spark):
    none = frame(spark, [(1, "x")]).limit(0)
    result, links = jaccard_join(none)
    assert result.count() == 0 and links.count() == 0
    assert substring_dedup(none).count() == 0
