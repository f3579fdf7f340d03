"""CSV records whose quoted text may hold line breaks, read side by side from the byte ranges of large files.

Whether a line starts a record depends on how many quotes stand before it in the file: an odd number means that it lies
inside quoted text. Spark's text reader deals a file out in byte ranges and gives each range the lines that start in it.

1. One scan counts the quotes of each range. A range turns the state that it is entered with (outside or inside quotes)
   into the same one or the other one; taken together from the front, each range knows the state it is entered with.
2. The few lines of records that reach over the end of a range are put together: the last record of one range with the
   first lines of those after it, up to the closing quote.
3. The records of a range are then put together by the task that reads it, without a shuffle.

The driver keeps three numbers for each byte range, and nothing that grows with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.staging import staged

_LINES = "_line", "_file", "_start", "_length"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    place = [F.col(f"_metadata.file_block_{x}").alias(f"_{x}") for x in ("start", "length")]
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("_line"), F.xxhash64("_metadata.file_path").alias("_file"), "_metadata.file_path", *place
    )


def entry_states(lines: DataFrame) -> DataFrame:
    """One row per byte range: whether it is entered, and left, inside quoted text."""
    quotes = F.length("_line") - F.length(F.translate("_line", '"', ""))
    odd = lines.groupBy("file_path", *_LINES[1:]).agg((F.sum(quotes) % 2).alias("odd"))
    upto = Window.partitionBy("file_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, 0)
    left = F.sum("odd").over(upto)
    return odd.select("file_path", *_LINES[1:], ((left - F.col("odd")) % 2).alias("enters"), (left % 2).alias("leaves"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of a CSV file or folder as text (``record``); ``first`` marks the first one of each file."""
    lines = _lines(spark, path)
    found = entry_states(lines).collect()  # one row per byte range
    if len({r["_file"] for r in found}) != len({r["file_path"] for r in found}):
        raise ValueError(f"two files of {path} have one hash: read them apart")
    # Three numbers for each byte range of Spark's files.maxPartitionBytes: about 200 KB for a TB.
    states = spark.sparkContext.broadcast({(r["_file"], r["_start"], r["_length"]): r["enters"] for r in found})
    lines = lines.select(*_LINES)
    whole = lines.mapInArrow(_assembler(states, False), "first boolean, record string")
    cut = [(r["_file"], r["_start"], r["_length"]) for r in found if r["enters"] or r["leaves"]]
    if not cut:
        return whole
    cut = spark.createDataFrame(cut, "_file long, _start long, _length long")
    pieces = staged(
        lines.join(F.broadcast(cut), list(_LINES[1:]), "left_semi")  # at most one row per byte range
        .select(*_LINES)
        .mapInArrow(_assembler(states, True), "_file long, _start long, tail boolean, first boolean, record string"),
        "pieces",
    )
    order = Window.partitionBy("_file").orderBy("_start", "tail").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("tail"), F.col("_start")), ignorenulls=True).over(order)
    parts = F.array_sort(F.collect_list(F.struct("_start", "tail", "record")))
    joined = (
        pieces.withColumn("owner", owner)
        .groupBy("_file", "owner")  # a record and the few ranges that it reaches over
        .agg(F.max("first").alias("first"), F.array_join(F.transform(parts, lambda x: x["record"]), "\n").alias("record"))
    )
    return whole.unionByName(joined.select("first", "record"))


def _assembler(states, pieces_only: bool):
    """Lines of ranges, in order, to their records; or only to the pieces of records that reach over an end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        here = None  # the range of the lines before
        inside, head, first, held = 0, False, False, None  # ``held``: lines of a record that is still open

        def made(records: pa.Array, start_of_file: bool) -> pa.RecordBatch:
            flags = np.zeros(len(records), bool)
            flags[:1] = start_of_file
            return pa.RecordBatch.from_arrays([pa.array(flags), records], names=["first", "record"])

        def piece(tail: bool) -> pa.RecordBatch:
            columns = [pa.array([here[0]]), pa.array([here[1]]), pa.array([tail]), pa.array([first]), pa.array(["\n".join(held)])]
            return pa.RecordBatch.from_arrays(columns, names=["_file", "_start", "tail", "first", "record"])

        for batch in batches:
            file, start, length = (batch.column(i).to_numpy() for i in (1, 2, 3))
            edges = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
            bounds = [0, *edges.tolist(), batch.num_rows]
            for low, high in zip(bounds[:-1], bounds[1:]):
                if low == high:
                    continue
                place = (int(file[low]), int(start[low]), int(length[low]))
                if place != here:
                    if held is not None and pieces_only:
                        yield piece(tail=not head)
                    if place not in states.value:
                        raise ValueError("files were split anew meanwhile: set spark.sql.files.minPartitionNum to a fixed number")
                    here, inside = place, states.value[place]
                    head, held, first = bool(inside), [] if inside else None, place[1] == 0
                lines = batch.column(0).slice(low, high - low)
                quotes = np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64))
                after = (inside + quotes) & 1
                before = np.concatenate(([inside], after[:-1]))
                inside = int(after[-1])
                starts = np.flatnonzero(before == 0)
                if not len(starts):
                    held += lines.to_pylist()
                    continue
                if held is not None:
                    held += lines.slice(0, int(starts[0])).to_pylist()
                    if head == pieces_only:
                        yield piece(tail=False) if head else made(pa.array(["\n".join(held)], pa.string()), first)
                    head, first, held = False, first and head, None
                ends = np.append(starts[1:], len(lines))
                if inside:
                    held = lines.slice(int(starts[-1])).to_pylist()
                    starts, ends = starts[:-1], ends[:-1]
                if len(starts):
                    if not pieces_only:
                        part = lines.slice(int(starts[0]), int(ends[-1] - starts[0]))
                        if len(part) != len(starts):
                            offsets = np.append(starts, ends[-1]) - starts[0]
                            part = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), part), "\n")
                        yield made(part, first)
                    first = False
        if held is not None and pieces_only:
            yield piece(tail=not head)

    return run
