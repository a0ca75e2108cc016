"""Every registered query against its DuckDB oracle on the smallest tables
(the driver's check runs the same pairs at sf0.01)."""

import pytest

import __spark_entry__ as entry
from tests.parity import compare, duck

NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


def test_every_query_has_an_oracle():
    from sifter.plans import catalog

    assert set(catalog.QUERIES) == set(catalog.ORACLES)  # tests/llm holds the others, if they are present
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, small_dir, name):
    r = compare(spark, con, small_dir, name, entry.queries()[name], entry.oracle_sql()[name])
    assert r["cols"] and r["count"] and r["hash"], (name, r["spark_rows"], r["duck_rows"])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["query_id", "best_match", "score", "doc_id", "page_no", "prompt"]
    assert df.count() >= 0
