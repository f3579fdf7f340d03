"""Latest rows and totals that are kept up to date from files as they arrive.

Both read new files with Structured Streaming and end when there are none left (``availableNow``). What a micro-batch
changes is written to a folder of its own number, so a batch that is run again after a failure writes the same rows to
the same place; readers take the whole of what the batches wrote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

BATCH = "_batch"


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of a folder, oldest first; a file is read once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _started(rows: DataFrame, target: str, checkpoint: str, mode: str, fold=None) -> StreamingQuery:
    def write(batch: DataFrame, number: int) -> None:
        made = batch if fold is None else fold(batch)
        made.write.mode("overwrite").parquet(f"{target}/{BATCH}={number}")

    return (
        rows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def keep_latest(
    stream: DataFrame, target: str, checkpoint: str, key: str, order: Column, columns: list[str]
) -> StreamingQuery:
    """Per key the row with the greatest ``order``: the state holds one row per key, a batch writes the keys it changed.

    A row that comes twice, or late, changes nothing unless it is the newest of its key.
    """
    newest = stream.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("_row"))
    return _started(newest, target, checkpoint, "update")


def latest(spark: SparkSession, target: str, key: str) -> DataFrame:
    """The kept rows: of each key, what its last batch wrote."""
    rows = spark.read.parquet(target)
    found = rows.groupBy(key).agg(F.max_by("_row", BATCH).alias("_row"))
    return found.select(key, *[F.col(f"_row.{f.name}") for f in rows.schema["_row"].dataType.fields if f.name != key])


def keep_totals(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    event_id: str,
    event_time: str,
    delay: str,
    by: dict[str, Column],
    totals: dict[str, Column],
) -> StreamingQuery:
    """Sums per group over events that each count once, however often they arrive.

    The state holds the ids of events of the last ``delay``; an event that arrives again meanwhile is dropped by its id,
    one that is older than the watermark by its time. A batch writes the sums of its new events (``totals`` are
    aggregates that can be added up).
    """
    once = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([event_id])

    def fold(batch: DataFrame) -> DataFrame:
        return batch.groupBy(*[c.alias(name) for name, c in by.items()]).agg(*[c.alias(n) for n, c in totals.items()])

    return _started(once, target, checkpoint, "append", fold)


def totals(spark: SparkSession, target: str, by: list[str]) -> DataFrame:
    """The sums over all batches."""
    rows = spark.read.parquet(target)
    return rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in (BATCH, *by)])
