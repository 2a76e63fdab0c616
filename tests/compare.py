"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations


def _key(row):
    return tuple((value is None, str(value)) for value in row)


def sorted_rows(columns, rows, ignore=()):
    names = sorted(c for c in columns if c not in ignore)
    at = [list(columns).index(c) for c in names]
    return names, sorted((tuple(row[i] for i in at) for row in rows), key=_key)


def assert_same(df, relation, ignore=()):
    got_names, got = sorted_rows(df.columns, df.collect(), ignore)
    names, want = sorted_rows([d[0] for d in relation.description], relation.fetchall(), ignore)
    assert got_names == names
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == w, [(n, a, b) for n, a, b in zip(names, g, w) if a != b]
