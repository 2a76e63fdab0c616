"""The queries on random sources with duplicates, NULLs and hot keys, against the literal SQL."""

from __future__ import annotations

import pytest

from oracle import oracle_statements
from oracle.inputs import INPUTS
from rollwise.queries import QUERIES
from rollwise.sources import sample_params
from tests.compare import assert_same
from tests.random_sources import duck_sources, random_rows, spark_sources

STATEMENTS = oracle_statements(frozenset(INPUTS))
CHECKED = list(QUERIES)


@pytest.fixture(scope="module", params=[1, 2])
def engines(request, spark):
    rows = random_rows(request.param)
    return spark_sources(spark, rows), duck_sources(rows)


@pytest.mark.parametrize("name", CHECKED)
def test_query(engines, name):
    sources, duck = engines
    assert_same(QUERIES[name](sources, sample_params()), duck.execute(STATEMENTS[name]))
