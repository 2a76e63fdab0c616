"""Brute-force versions of the operators, over plain Python rows."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text, lower=True):
    text = text or ""
    return WORD.findall(text.translate(_LOWER) if lower else text)


def shingles(text):
    w = words(text)
    return frozenset(zip(*[w[i:] for i in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(texts, percent=75):
    """{doc_id: smallest doc_id reached} of a {doc_id: text}."""
    sets = {k: shingles(t) for k, t in texts.items()}
    up = {k: k for k in sets}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}


def without_repeats(rows, window=50):
    """[(doc_id, words, kept words)] of [(doc_id, text)]."""
    first = {}
    for doc, text in rows:
        w = words(text, lower=False)
        for i in range(len(w) - window + 1) if doc is not None else ():
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = words(text, lower=False)
        gone = set()
        for i in range(len(w) - window + 1) if doc is not None else ():
            if first[tuple(w[i : i + window])] < doc:
                gone |= set(range(i, i + window))
        out.append((doc, w, [x for i, x in enumerate(w) if i not in gone]))
    return out


def level_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """{source: target}: shares by weight, the excess over the cap dealt again until none is left."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, goal = {}, share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        left = goal - sum(full.values())
        level = left / sum(w[s] for s in rest) if rest else 0
        over = [s for s in rest if w[s] * level >= cap * sizes[s]]
        if not over:
            return full | {s: w[s] * level for s in rest}
        full |= {s: float(cap * sizes[s]) for s in over}
