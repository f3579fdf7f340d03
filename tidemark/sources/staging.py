"""Staged tables: an intermediate result written once to the cluster's shared folder and read back.

Several operators read one intermediate result more than once (quantiles, then flags against
them). Staging gives all passes the same values, cuts the lineage, and survives lost executors,
because the files live in the shared folder and not on an executor.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_open_blocks: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; only a local session may fall back to a temporary one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder, removed with the ``released`` block around it or the session."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    file_system.mkdirs(hadoop_path)
    file_system.deleteOnExit(hadoop_path)
    if _open_blocks:
        _open_blocks[-1].append(path)
    return path


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Folders made inside the block go when it ends, so results must be written by then."""
    made: list[str] = []
    _open_blocks.append(made)
    try:
        yield
    finally:
        _open_blocks.remove(made)
        for path in made:
            hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def staged(df: DataFrame, label: str = "stage", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and return a frame that reads the written table."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)
