"""Registered queries: against SQL where there is SQL, and the pipeline against brute force."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
import brute_pipeline

FOLDER = "/root/testdata/sf0.001"


def test_names():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


@pytest.mark.parametrize("name", ["op6_warc", "op10_decontamination", "op13_phrases"])
def test_query_matches_sql(llm, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    found = entry.queries()[name](llm, FOLDER).select(*columns).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, cursor.fetchall()))


def test_pipeline_equals_brute_force(llm):
    docs = [tuple(r) for r in llm.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in llm.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    expected = brute_pipeline.run(docs, items)
    found = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.run(llm, FOLDER).collect()}
    assert found == expected
