"""What every operator shares: reading its columns, staged tables that can be dropped, and Arrow loops.

Operators take only the columns they name, so other columns of a table, whatever they are called, never meet the
columns that an operator adds.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.staging import shared_folder

#: Bytes of text that a task turns into arrays at a time. A longer text is handled alone.
SLICE_BYTES = 1 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, which may not have it installed; once for each Spark application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Two columns: the id and the text as UTF-8 bytes (a missing text stays missing)."""
    return docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("binary").alias("text")
    )


class Staging:
    """Tables written once to the cluster's shared folder, removed together when the block ends.

    Tasks that are run again read the files, so a lost executor costs no earlier work. ``keep`` leaves a table for
    the rest of the session: the result that is handed back reads it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self._made: list[str] = []
        self._kept: set[str] = set()

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        for path in self._made:
            if path not in self._kept:
                self.drop(path)

    def _hadoop(self, path: str):
        found = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def drop(self, path: str) -> None:
        found, system = self._hadoop(path)
        system.delete(found, True)

    def folder(self, name: str) -> str:
        path = f"{self.base}/{name}"
        found, system = self._hadoop(path)
        system.mkdirs(found)
        system.deleteOnExit(found)
        self._made.append(path)
        return path

    def keep(self, path: str) -> None:
        self._kept.add(path)

    def put(
        self, df: DataFrame, name: str, keep: bool = False, codec: str = "zstd", group_bytes: int | None = None
    ) -> DataFrame:
        """``group_bytes`` is for tables of large rows: a row group ends with the row that reaches it. Else Spark's
        writer looks at what it holds every 100 rows only, and its reader fetches as many at once."""
        path = f"{self.base}/{name}"
        writer = df.write.option("compression", codec)
        if group_bytes:
            writer = writer.option("parquet.block.size", group_bytes).option("parquet.page.size.row.check.min", 1)
        writer.parquet(path)
        found, system = self._hadoop(path)
        system.deleteOnExit(found)
        self._made.append(path)
        if keep:
            self._kept.add(path)
        # The table takes the place of the shuffle files behind it; Spark drops those once the driver's JVM has
        # noticed that nothing refers to them.
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self, name: str) -> None:
        self.drop(f"{self.base}/{name}")


BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What runs inside hands rows to Python in batches that end with the row that reaches ``size`` bytes.

    A batch is held by Spark outside its heap, twice over while its arrays grow, and by Python.
    """
    before = spark.conf.get(BATCH_SETTING, None)
    bytes_of = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if before is None or not 0 < bytes_of(before) <= size:
        spark.conf.set(BATCH_SETTING, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, before)


def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """One row after the other; bytes are buffers that lie in the batch, not copies."""
    for batch in batches:
        columns = [(f.name, batch.column(i), pa.types.is_binary(f.type)) for i, f in enumerate(batch.schema)]
        for i in range(batch.num_rows):
            yield {name: column[i].as_buffer() if binary else column[i].as_py() for name, column, binary in columns}


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows again, in runs that hold about ``SLICE_BYTES`` of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = size = 0
        for i, n in enumerate(lengths):
            if size and size + n > SLICE_BYTES:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += int(n)
        yield batch.slice(start)


def map_slices(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``make`` to slices of ``df`` inside tasks; it must have a ``text`` column of bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = make(batch)
            if made is not None:
                yield made

    return df.mapInArrow(run, schema)


def whole(batches: list[pa.RecordBatch], limit: int = (1 << 31) - 1) -> pa.RecordBatch:
    """All rows as one batch. Bytes beyond ``limit`` need wide offsets, without which Arrow makes several batches."""
    table = pa.Table.from_batches(batches)
    fields = [
        f.with_type(pa.large_binary()) if pa.types.is_binary(f.type) and table.column(f.name).nbytes > limit else f
        for f in table.schema
    ]
    found = table.cast(pa.schema(fields)).combine_chunks().to_batches()
    if len(found) != 1:
        raise ValueError(f"{table.num_rows} rows do not make one batch")
    return found[0]
