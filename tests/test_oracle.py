"""Every registered query against its SQL in DuckDB, over the whole small test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.oracle import oracle_sql
from tidemark.queries import REGISTRY

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
NOT_SQL = {"segments", "segment_summary", "elbow_cost"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _sorted(records, columns):
    rows = [tuple(None if isinstance(r[c], float) and math.isnan(r[c]) else r[c] for c in columns) for r in records]
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_sql():
    assert set(REGISTRY) - set(oracle_sql()) == NOT_SQL
    assert set(oracle_sql()) <= set(REGISTRY) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = REGISTRY[name](spark, FOLDER)
    cursor = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    expected = [dict(zip(columns, row)) for row in cursor.fetchall()]
    ordered = sorted(columns)
    assert _sorted([r.asDict() for r in df.collect()], ordered) == _sorted(expected, ordered)


@pytest.mark.parametrize("name", sorted(NOT_SQL))
def test_clusters(spark, name):
    found = REGISTRY[name](spark, FOLDER).collect()
    assert found
    if name == "segments":
        assert {r["Segment"] for r in found} <= {"High Value", "Support Heavy", "Growing Users", "Low Engagement"}


def test_entry(spark):
    if os.path.isdir("/root/testdata/sf0.001"):
        assert entry.entry(spark).count() > 0
