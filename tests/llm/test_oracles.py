"""The text queries that SQL can express, against DuckDB on the driver's tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from shelfcast.llm.queries import ORACLES, QUERIES


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([(columns[i], type(row[i]).__name__, row[i]) for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data_dir, name):
    duck = duckdb.connect()
    for path in Path(data_dir).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    expected = duck.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    wanted = expected.fetchall()
    found = QUERIES[name](spark, data_dir)
    assert sorted(found.columns) == sorted(columns) and wanted
    assert rows_of(found.columns, found.collect()) == rows_of(columns, wanted)


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [n for i in range(1, 14) for n in names if n.startswith(f"op{i}_")] == sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())
