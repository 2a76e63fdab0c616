"""Clustering, divergence audit and packing against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rollwise.llm.divergence import source_divergence
from rollwise.llm.packing import Bin, packed, placements, sequences
from rollwise.llm.ptolemaic import centroid_clusters, start_clusters


def plain_clusters(rows, k, rounds, dims, scale):
    """[(vec_id, cluster, distance)] and the final centroids, in whole numbers."""
    kept = [(i, [math.floor(x * scale) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centers = [v for _, v in order[:k]]

    def apart(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    for step in range(rounds + 1):
        found = [(i, *min((apart(v, c), n) for n, c in enumerate(centers)), v) for i, v in kept]
        if step < rounds:
            for n in range(len(centers)):
                own = [v for _, _, c, v in found if c == n]
                if own:
                    centers[n] = [sum(x) // len(own) for x in zip(*own)]
    return [(i, c, d) for i, d, c, _ in found], centers


def test_clusters_edge_cases(spark):
    draw = random.Random(5)
    rows = [(i, [draw.gauss(0, 1) + 3 * (i % 3) for _ in range(4)]) for i in range(150)]
    rows += [(200, [1e30, -1e30, 5.0, 0.0]), (201, [1e30, -1e30, 6.0, 0.0]), (202, [2.0**40, 1.0, 0.0, 0.0])]
    rows += [(None, [0.5, 0.5, 0.5, 0.5]), (7, [0.0] * 4), (7, [0.0] * 4), (7, [-0.01] * 4)] + [(300 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(60)]
    bad = [(400, None), (401, [1.0] * 3), (402, [1.0, None, 0.0, 0.0]), (403, [float("nan")] * 4), (404, [float("inf"), 0.0, 0.0, 0.0]), (405, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + bad], "vec_id long, embedding array<double>, cluster string").repartition(5)
    got = centroid_clusters(df, clusters=6, rounds=3, dims=4)
    want, centers = plain_clusters(rows, 6, 3, 4, 64)
    inertia = {c: sum(d for _, x, d in want if x == c) for c in range(6)}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    most = 2**63 - 1
    full = [(i, c, min(d, most), min(inertia[c], most), min(sum(inertia.values()), most), digests[c]) for i, c, d in want]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, full))


def test_pivots_exclude_centroids_but_never_the_nearest(spark):
    draw = random.Random(6)
    rows = [(i, [draw.gauss(0, 0.2) + 20 * ((i % 9) >> k & 1) for k in range(4)]) for i in range(400)]
    run = start_clusters(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), clusters=9, dims=4)
    run.move()
    found = run.assigned().collect()
    assert sum(r.compared for r in found) < 9 * len(found)
    want, _ = plain_clusters(rows, 9, 1, 4, 64)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in found) == sorted(want)


def test_clusters_of_few_or_no_vectors(spark):
    few = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert [(r.cluster, r.distance, r.inertia) for r in centroid_clusters(few, clusters=4, dims=2).collect()] == [(0, 0, 0)] * 2
    none = centroid_clusters(few.limit(0), clusters=4, dims=2)
    assert none.count() == 0 and none.columns == centroid_clusters(few, clusters=4, dims=2).columns


TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain_divergence(rows, least, top):
    docs = [(lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t in held if held[t] >= least)
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if held[t] >= least) for s in {d[1] for d in own}}

        def shares(count):
            return {t: 1 + 10**9 * (count[t] + 2) // (sum(count.values()) + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))
        for s in counts:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in counts if o != s]
            term = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, item, -value, i + 1) for i, (value, _, item) in enumerate(found)]
    return sorted(out)


def test_divergence_edge_cases(spark):
    draw = random.Random(7)
    vocabulary = ["Alpha", "alpha", "beta", "\u00e9t\u00e9", "\u00c9T\u00c9", "z\U0001f600z", "the", "THE", "of", "x1y", "k\x00k", "a_b", "\u03a3\u03c3"]
    rows = []
    for i in range(260):
        words = draw.choices(vocabulary, k=draw.randrange(0, 12)) + ["the"] * (i % 4)
        rows.append((" ".join(words), draw.choice(["en", "de", None, ""]), draw.choice(["hot"] * 5 + ["a", "b", "\uffee", "\U0001f600", None, ""])))
    rows += [(None, "en", "silent"), ("", "en", "blank"), ("... 123", "en", "marks"), ("lone words here", "xx", "only"), ("same again", "yy", "s1"), ("same again", "yy", "s2")]
    rows += [("a\tlong " * 30000, "en", "long")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "text string, lang string, source string, part int, value int").repartition(6)
    want = plain_divergence(rows, 10, 3)
    got = source_divergence(df, top=3, block=3)
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect())) == want
    assert sorted(map(tuple, source_divergence(df.select("source", "text", "lang"), top=3).collect())) == want
    assert source_divergence(df.limit(0)).count() == 0


def test_divergence_of_a_wide_term_sends_sums_not_pairs(spark):
    """A term in every source: as many sums as pairs of groups, whatever the number of documents."""
    rows = [(" ".join(["the", "of", f"w{i % 7}"]), "en", f"s{i % 30:02}") for i in range(1200)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sorted(map(tuple, source_divergence(df, top=5).collect())) == plain_divergence(rows, 10, 5)


def one_by_one(lengths, of):
    """Remainders of the bins when pieces are placed singly."""
    bins = []
    for length in sorted(lengths, reverse=True):
        need = (length, 1, length * length)
        best = None
        for i, left in enumerate(bins):
            if all(x >= y for x, y in zip(left, need)):
                parts = [(x / c, y / c) for x, y, c in zip(left, need, of.capacities)]
                if of.select == "norm":
                    score = float(np.array([(x - y) ** 2 for x, y in parts]) @ np.array(of.weights))
                else:
                    score = -float(np.array([x * y for x, y in parts]) @ np.array(of.weights))
                if best is None or (score, left) < best[:2]:
                    best = (score, left, i)
        if best is None:
            bins.append(of.capacities)
            best = (0, bins[-1], len(bins) - 1)
        bins[best[2]] = tuple(x - y for x, y in zip(best[1], need))
    return sorted(bins)


@pytest.mark.parametrize("of", [Bin(40), Bin(40, pieces=5), Bin(40, cost=700), Bin(40, select="dot"), Bin(40, pieces=4, cost=900, select="dot")])
def test_ranges_of_pieces_go_where_single_pieces_would(of):
    draw = random.Random(9)
    for size in (0, 1, 30, 400):
        lengths = [min(int(draw.expovariate(0.12)) + 1, 26) for _ in range(size)]
        used = defaultdict(list)
        plan = placements(Counter(lengths), of)
        for (length, rank, each, first, offset), after in zip(plan, [*plan[1:], (0, 0)]):
            end = after[1] if after[0] == length else Counter(lengths)[length]
            for r in range(end - rank):
                used[first + r // each].append((offset + r % each * length, length))
        left = []
        for own in used.values():
            own.sort()
            assert [o for o, _ in own] == [sum(x for _, x in own[:i]) for i in range(len(own))]
            left.append((of.tokens - sum(x for _, x in own), of.capacities[1] - len(own), of.capacities[2] - sum(x * x for _, x in own)))
        assert all(min(x) >= 0 for x in left) and sorted(left) == one_by_one(lengths, of)


def test_packed_documents(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    draw = random.Random(10)
    words = ["It's", "we'LL", "na\u00efve", "e\u0301t\u00e9", "\u0301x", "<|endoftext|>", "a\u00a0b", "\u2003", "12.5", "\u4f60\u597d", "don't...", "\U0001f600", "\u03a3", "x" * 300, "\x1c\x85y"]
    rows = [(i, " ".join(draw.choices(words, k=draw.randrange(0, 60))), draw.choice("ab")) for i in range(120)]
    rows += [(500, None, "a"), (501, "", "a"), (502, " \t\n", "a"), (None, "no id", None), (7, "twice", "a"), (7, "twice", "a"), (503, "long text\n" * 3000, "b")]
    rows += [(600 + i, "the same words again and again", "hot") for i in range(300)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, task string, length int").repartition(6)
    of = Bin(256, pieces=40, cost=50000 + 256 * 256)
    tokenizer = Tokenizer.from_file(path)
    want = []
    for doc, text, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for n, lo in enumerate(range(0, len(ids), 256)):
            data = np.array(ids[lo : lo + 256], "<u4").tobytes()
            want.append((str(doc), n, lo, len(data) // 4, zlib.crc32(data)))
    for ids in (True, False):
        out = packed(df, path, of, ids=ids)
        got = out.collect()
        assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
        held = defaultdict(list)
        for r in got:
            held[r.sequence_id].append((r.offset, r.length))
        for own in held.values():
            own.sort()
            assert [o for o, _ in own] == [sum(x for _, x in own[:i]) for i in range(len(own))]
            assert sum(x for _, x in own) <= 256 and len(own) <= 40 and sum(x * x for _, x in own) <= 50000 + 256 * 256
        left = sorted((256 - sum(x for _, x in o), 40 - len(o), of.cost - sum(x * x for _, x in o)) for o in held.values())
        assert left == one_by_one([r.length for r in got], of)
    whole = {r.sequence_id: r for r in sequences(packed(df, path, of)).collect()}
    assert sum(len(r.ids) for r in whole.values()) == 4 * sum(r[3] for r in want)
    assert sorted(zlib.crc32(r.ids[4 * a : 4 * b]) for r in whole.values() for a, b in zip(r.offsets, [*r.offsets[1:], len(r.ids) // 4])) == sorted(r[4] for r in want)
    none = packed(df.limit(0), path)
    assert none.count() == 0 and "sequence_id" in none.columns


def test_packing_query_fills_sequences(spark):
    from rollwise.llm.queries import QUERIES

    rows = QUERIES["op13_vector_packing"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len({r.sequence_id for r in rows}) <= 1 + -(-sum(r.length for r in rows) // 4096)
