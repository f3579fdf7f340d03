"""Global order without a single task: range partitions plus per-partition offsets.

``Window.orderBy`` without a partition key sends every row to one task. Here the rows are range
partitioned, the partitions are written with their number, and only per-partition summaries (as
many rows as there are partitions) are combined to offset the positions found inside each one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.staging import staged

PART = "_part"


def range_parts(df: DataFrame, *order: Column, partitions: int | None = None) -> DataFrame:
    """Range partition by ``order`` and stage the rows with their partition number."""
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return staged(ranged.withColumn(PART, F.spark_partition_id()), "ordered")


def _with_local_rank(ordered: DataFrame, by: str) -> DataFrame:
    """Sorted partitions with the rank of each row inside its own (``_local``): one streaming pass, no shuffle."""
    place = ordered.columns.index(by)
    schema = T.StructType([*ordered.schema.fields, T.StructField("_local", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        def differs(a: pa.Array, b: pa.Array) -> np.ndarray:
            """Where values differ as Spark has it: missing equals missing, NaN equals NaN."""
            other = pc.fill_null(pc.not_equal(a, b), True)
            same = pc.and_(pc.is_null(a), pc.is_null(b))
            if pa.types.is_floating(a.type):
                same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
            return pc.and_not(other, same).to_numpy(zero_copy_only=False)

        passed, rank, last = 0, 1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(place)
            new = np.ones(batch.num_rows, bool)
            new[1:] = differs(column.slice(1), column.slice(0, len(column) - 1))
            if last is not None:
                new[0] = differs(column.slice(0, 1), last)[0]
            at = np.maximum.accumulate(np.where(new, passed + 1 + np.arange(batch.num_rows), rank))
            rank, passed, last = int(at[-1]), passed + batch.num_rows, column.slice(len(column) - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], names=[*batch.schema.names, "_local"])

    return ordered.mapInArrow(run, schema)


def rank_descending(
    df: DataFrame, by: str, tie_break: str, output: str, partitions: int | None = None
) -> DataFrame:
    """``RANK() OVER (ORDER BY by DESC)``, NULL last, exact for any type, number of rows and ties.

    ``tie_break`` must be unique: it lets a large group of equal values spread over partitions. Values keep their own
    type, so NaN, infinities, missing values and long numbers rank as in a window. The rows are shuffled once, and
    counted while their partition is written.
    """
    order = F.col(by).desc_nulls_last(), F.col(tie_break)
    rows = staged(df, "rank-input")
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    sorted_parts = ranged.sortWithinPartitions(*order).withColumn(PART, F.spark_partition_id())
    ordered = staged(_with_local_rank(sorted_parts, by), "ranked")
    value = F.struct(F.col(by).alias("value"))
    summary = staged(
        ordered.groupBy(PART).agg(
            F.count(F.lit(1)).alias("rows"),
            F.min_by(value, "_local").alias("first"),
            F.max_by(value, "_local").alias("last"),
            (F.count(F.lit(1)) - F.max("_local") + 1).alias("rows_at_last"),
        ),
        "rank-parts",
    )
    # Rows before a partition that equal its first value stand at the ends of partitions whose last value it is.
    here, other = summary.alias("here"), summary.alias("other")
    tied = F.col("here.first").eqNullSafe(F.col("other.last")) & (F.col(f"other.{PART}") < F.col(f"here.{PART}"))
    carried = (
        here.join(other, tied, "left")
        .groupBy(F.col(f"here.{PART}").alias(PART))
        .agg(F.first("here.rows").alias("rows"), F.coalesce(F.sum("other.rows_at_last"), F.lit(0)).alias("_carried"))
    )
    offsets, before = [], 0
    for part in carried.orderBy(PART).collect():  # one row per partition, counts only
        offsets.append((part[PART], before, part["_carried"]))
        before += part["rows"]
    offsets = df.sparkSession.createDataFrame(offsets, f"{PART} int, _before long, _carried long")
    return (
        ordered.join(F.broadcast(offsets), PART)  # one row per partition
        .withColumn(output, F.col("_local") + F.col("_before") - F.when(F.col("_local") == 1, F.col("_carried")).otherwise(0))
        .select(*df.columns, output)
    )
