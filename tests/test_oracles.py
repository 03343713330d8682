"""Every query with an SQL twin gives the same rows as the twin in DuckDB."""
import math

import duckdb
import pytest

from riskframe.checks.oracles import ORACLES
from riskframe.checks.queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck(data_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data_dir}/{name}.parquet'")
    return con


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_every_twin_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_twin(spark, duck, data_dir, name):
    ours = QUERIES[name](spark, data_dir)
    theirs = duck.execute(ORACLES[name])
    names = [d[0] for d in theirs.description]
    assert sorted(names) == sorted(ours.columns)
    left = sorted(([plain(v) for v in r] for r in ours.select(*names).collect()), key=repr)
    right = sorted(([plain(v) for v in r] for r in theirs.fetchall()), key=repr)
    assert left == right
