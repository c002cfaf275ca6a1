"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import math
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from testbed.queries import QUERIES as testbed_queries

SF_DIR = os.environ.get("MATFLOW_TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return None if value is None else str(value)


def _arrow_rows(table):
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    kinds = {name: str(table.schema.field(name).type).replace("large_", "") for name in names}
    return kinds, Counter(tuple(_cell(v) for v in row) for row in zip(*columns))


def test_names_agree():
    assert ORACLES.keys() <= QUERIES.keys()
    assert testbed_queries.keys() <= ORACLES.keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    got_kinds, got = _arrow_rows(QUERIES[name](spark, SF_DIR).toArrow())
    expected = duck.execute(ORACLES[name]).to_arrow_table()
    want_kinds, want = _arrow_rows(expected)
    assert got_kinds == want_kinds
    assert sum(got.values()) == sum(want.values())
    assert got == want
    assert got, "no rows"
