"""Every query that has SQL gives the rows of its SQL."""

import duckdb
import pytest

from chorale.llm import queries

TABLES = "documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted(tuple(str(row[n]) for n in order) for row in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, duck, folder, name):
    ours = queries.QUERIES[name](spark, folder)
    theirs = duck.execute(queries.ORACLE[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(columns) == sorted(ours.columns)
    assert rows_of(ours.collect(), ours.columns) == rows_of(theirs.fetchall(), columns)


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
