"""Correlations of many columns from one reading of the rows.

Each task folds its batches into matrices: for every pair of columns the number of rows that have both, their means over
those rows and the centred sums of squares and products (one matrix product each, with masks for missing values). A
task hands over one row per pair; these few rows are merged around the common mean, which keeps large means harmless.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.staging import staged

_MOMENTS = "a int, b int, n double, mean_a double, mean_b double, aa double, bb double, ab double"


def pair_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per ordered pair of columns and task: rows that have both, their means, and centred sums; NaN counts as missing."""
    width = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        n, mean, square, product = (np.zeros((width, width)) for _ in range(4))  # of a, over the rows that have a and b
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)])
            seen = ~np.isnan(x)
            mask = seen.astype(float)
            # Sums are taken around the medians, so neither a large mean nor an outlier costs the others digits.
            centre = np.array([np.median(c[s]) if s.any() else 0.0 for c, s in zip(x.T, seen.T)])
            z = np.where(seen, x - centre, 0)
            m = mask.T @ mask
            local = (z.T @ mask) / np.maximum(m, 1)
            squares = (z * z).T @ mask - m * local**2
            products = z.T @ z - m * local * local.T
            both = np.maximum(n + m, 1)
            apart = np.where(m > 0, local + centre[:, None] - mean, 0)
            square += squares + apart**2 * n * m / both
            product += products + apart * apart.T * n * m / both
            mean += apart * m / both
            n += m
        a, b = np.divmod(np.arange(width * width), width)
        values = [n, mean, mean.T, square, square.T, product]
        columns_ = [pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), *[pa.array(v.ravel()) for v in values]]
        yield pa.RecordBatch.from_arrays(columns_, names=[c.split()[0] for c in _MOMENTS.split(", ")])

    return df.select([F.col(c).cast("double").alias(c) for c in columns]).mapInArrow(run, _MOMENTS)


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """``a``, ``b`` (places in ``columns``) and Pearson's ``r`` over rows that have both; missing if one is constant."""
    parts = staged(pair_moments(df, columns), "moments").filter("n > 0")
    means = parts.groupBy("a", "b").agg(
        (F.sum(F.col("n") * F.col("mean_a")) / F.sum("n")).alias("to_a"),
        (F.sum(F.col("n") * F.col("mean_b")) / F.sum("n")).alias("to_b"),
    )
    off_a, off_b = F.col("mean_a") - F.col("to_a"), F.col("mean_b") - F.col("to_b")
    merged = (
        parts.join(F.broadcast(means), ["a", "b"])  # one row for each pair of columns
        .groupBy("a", "b")
        .agg(
            F.sum(F.col("aa") + F.col("n") * off_a * off_a).alias("aa"),
            F.sum(F.col("bb") + F.col("n") * off_b * off_b).alias("bb"),
            F.sum(F.col("ab") + F.col("n") * off_a * off_b).alias("ab"),
        )
    )
    return merged.select("a", "b", F.try_divide("ab", F.sqrt(F.col("aa")) * F.sqrt(F.col("bb"))).alias("r"))
