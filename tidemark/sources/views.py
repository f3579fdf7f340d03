"""Business tables as named relations for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
