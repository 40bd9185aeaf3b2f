"""Every query against its SQL counterpart on DuckDB."""

import os

import pytest

from goldpan.oracles import all_oracles as oracle_sql
from goldpan.queries import all_queries as queries
from tests.compare import connect, duck_bag, duck_types, spark_bag, spark_types

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

# Ties at the edges are rare on the smallest tables: these run on larger ones, too.
LARGER = "/root/testdata/sf0.01"
ALSO_LARGER = ("dedup_natural_key", "silver_full_refresh", "silver_incremental", "gold_category_region", "gold_products")


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


def same_rows(spark, duck, name, sf_dir):
    result = queries()[name](spark, sf_dir)
    assert spark_types(result) == duck_types(duck, oracle_sql()[name])
    columns, rows = spark_bag(result)
    expected_columns, expected = duck_bag(duck, oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, duck, name):
    same_rows(spark, duck, name, SF_DIR)


@pytest.mark.parametrize("name", ALSO_LARGER)
def test_same_rows_on_larger_tables(spark, name):
    connection = connect(LARGER)
    same_rows(spark, connection, name, LARGER)
    connection.close()
