"""Every registered query against DuckDB, with keys cut into small slices, and join keys that are spread."""

import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from logharbor.plans.catalog import QUERIES
from logharbor.session import SLICE_ROWS_KEY, MAX_GROUP_ROWS_KEY
from tests.compare import compare, connect
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_its_oracle(spark, con, name):
    spark.conf.set(MAX_GROUP_ROWS_KEY, "30")
    spark.conf.set(SLICE_ROWS_KEY, "40")
    try:
        ok, note = compare(spark, con, queries()[name], oracle_sql().get(name), SF)
    finally:
        spark.conf.unset(MAX_GROUP_ROWS_KEY)
        spark.conf.unset(SLICE_ROWS_KEY)
    assert ok, note


@pytest.mark.parametrize("blocked", ["public_tokenizers", "tokenizers", "logharbor.llm", "logharbor.llm.queries", "corpus_pipeline"])
def test_other_queries_are_there_without_the_text_operators(monkeypatch, blocked):
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("logharbor.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, blocked, None)
    names, sql = set(queries()), set(oracle_sql())
    assert set(QUERIES) <= names and sql <= names and "pipeline" not in names | sql


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0
