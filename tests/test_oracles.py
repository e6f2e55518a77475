"""Every query with SQL of its own, on the smallest tables, against DuckDB."""

import math
import os

import pytest

from arborel.plans.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    base = duckdb.connect()
    for t in TABLES:
        base.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return base


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 6) + 0.0
    return str(v)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE_SQL])
def test_runs(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    assert QUERIES[name](spark, SF).count() > 0
