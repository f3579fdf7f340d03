"""Latest row per key by an aggregate.

The newest row of a key is found by ``max_by`` on the map side first, so a key that holds a large
part of the rows sends one row per task and is never sorted in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_last(column: str, tie_break: str) -> Column:
    """Ascending order in which a missing value comes last and so counts as the latest."""
    return F.struct(F.col(column).isNull(), F.col(column), F.col(tie_break))


def latest_rows(
    df: DataFrame, key: str, by: str, tie_break: str, columns: list[str] | None = None
) -> DataFrame:
    """One row per key: the row with the greatest ``by``, a missing ``by`` being the greatest."""
    kept = columns if columns is not None else [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*kept), missing_last(by, tie_break))
    return df.groupBy(key).agg(newest.alias("_row")).select(key, *[F.col(f"_row.{c}") for c in kept])


def last_value(column: str, by: str, tie_break: str) -> Column:
    """Aggregate: the last value of ``column`` that is not missing; as everywhere, a missing ``by`` comes last."""
    present = F.when(F.col(column).isNotNull(), missing_last(by, tie_break))
    return F.max_by(column, present)
