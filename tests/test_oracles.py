"""Every query of the core with SQL against that SQL, on the smallest tables."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
import pytest

from pagewright.plans import queries as core

DATA = "/root/testdata/sf0.001"
NAMES = sorted(core.oracle_sql())


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        connection.execute(f"CREATE VIEW \"{name.split('.')[0]}\" AS SELECT * FROM read_parquet('{DATA}/{name}')")
    return connection


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    return f"{float(value):.9g}" if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_sql(spark, db, name):
    made = core.queries()[name](spark, DATA)
    columns = sorted(made.columns)
    want = db.execute(core.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == columns
    ours = Counter(tuple(plain(r[c]) for c in columns) for r in made.collect())
    theirs = Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in want.fetchall())
    assert ours == theirs
