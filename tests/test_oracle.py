"""Every registered query against its DuckDB oracle (row count, column names,
order-insensitive value hash), the same comparison the driver makes."""

import pytest

import __spark_entry__ as entry
import oracle_compare as oc
from tidemark.plans.queries import REGISTERED

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oc.duck(sf_dir)


def test_every_query_of_the_reference_has_an_oracle():
    # The training-data queries that SQL cannot express are held against brute force in tests/llm.
    assert set(REGISTERED) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, sf_dir, duck, key):
    sres = oc.spark_rows(QUERIES[key](spark, sf_dir))
    dres = oc.duck_rows(duck, SQL[key])
    assert oc.digest(*sres) == oc.digest(*dres), oc.diff(sres, dres)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["symbol", "asset_type", "price_date"]
