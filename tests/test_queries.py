"""Every registered query of the analytics library against its SQL, or that it gives rows."""

import pytest
from compare import assert_same, database

from tidemark.plans.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return database(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, sf, con):
    assert_same(QUERIES[name](spark, sf), con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(name, spark, sf):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry_gives_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_all_stored_articles_are_read(spark, sf):
    assert QUERIES["src5_read_all_articles"](spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()
