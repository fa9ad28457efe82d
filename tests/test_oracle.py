"""Every registered query against its SQL oracle on the driver's tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module

QUERIES = {name: query for name, query in entry_module.queries().items() if name.startswith("q_")}
ORACLES = {name: sql for name, sql in entry_module.oracle_sql().items() if name.startswith("q_")}


@pytest.fixture(scope="module")
def duck(data_dir):
    connection = duckdb.connect()
    for path in Path(data_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple((columns[i], type(row[i]).__name__, repr(row[i])) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, data_dir, name):
    result = QUERIES[name](spark, data_dir)
    expected = duck.execute(ORACLES[name])
    expected_columns = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(expected_columns)
    expected_rows = expected.fetchall()
    assert expected_rows, "an empty result proves little"
    assert multiset(result.columns, result.collect()) == multiset(expected_columns, expected_rows)
