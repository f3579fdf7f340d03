from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.schemas import BUSINESS  # noqa: E402
from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Build a business table from rows given as dicts; columns left out are missing."""

    def make(name: str, rows: list[dict]):
        schema = BUSINESS[name]
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)

    return make


@pytest.fixture(scope="session")
def rows():
    def collect(df, *keys):
        found = [r.asDict() for r in df.collect()]
        return sorted(found, key=lambda r: tuple(str(r[k]) for k in keys)) if keys else found

    return collect


@pytest.fixture(scope="session")
def by_key():
    def index(df, key="CustomerID"):
        return {r[key]: r.asDict() for r in df.collect()}

    return index
