"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tools.check_queries import TABLES, rows_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, db, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    columns, got = rows_of(frame.columns, frame.collect())
    if name not in ORACLES:
        assert got
        return
    result = db.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert (columns, list(map(repr, got))) == tuple(
        f(x) for f, x in zip((list, lambda rows: list(map(repr, rows))), rows_of(names, result.fetchall()))
    )


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_points.queries())
