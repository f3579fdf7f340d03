"""Approximate distinct counts from sketches that can be merged without the rows.

A sketch is a binary column. Sketches of parts of a table, stored once, merge to the sketch of the whole, so counts for
coarser groups, or for more data, need no second look at the rows. Exact counts stay the default everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH = "Sketch"
#: Logarithm of the registers of a sketch: at 14 it has 16 KB, and a standard error under one in a hundred.
LOG_REGISTERS = 14


def distinct_sketches(df: DataFrame, by: list[str], column: str, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """One sketch of the values of ``column`` per group; missing values are not counted."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, F.lit(log_registers)).alias(SKETCH))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of coarser groups, from those of finer ones."""
    return sketches.groupBy(*by).agg(F.hll_union_agg(SKETCH).alias(SKETCH))


def estimate(sketch: Column | str = SKETCH) -> Column:
    return F.hll_sketch_estimate(sketch)
