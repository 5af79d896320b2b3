import math
import sys

import duckdb
import pytest

import __spark_entry__ as contract
from chorale.plans import catalogue
from chorale.plans.oracle import ORACLE

TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES, SQL = catalogue.QUERIES, ORACLE
# Fitted afresh by each query and covered in test_factors.
SLOW = {"als_test", "tune_edge_check", "als_fit_scaling", "compare_models", "als_tune", "lsh_vs_exact_top_n", "bounds_vs_exact_top_n"}


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def shape(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return str(value)


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted(tuple(shape(row[n]) for n in order) for row in rows)


def test_every_text_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, folder, name):
    ours = QUERIES[name](spark, folder)
    theirs = duck.execute(SQL[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(columns) == sorted(ours.columns)
    assert rows_of(ours.collect(), ours.columns) == rows_of(theirs.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_query_without_sql_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r.k for r in sorted(rows, key=lambda r: r.k)] == [10, 100]
    assert all(r.n_users == 15 for r in rows)
    assert "chorale" in sys.modules
