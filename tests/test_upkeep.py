import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.latest import missing_last
from tidemark.streaming import upkeep

ROWS = "k string, day date, id long, x double"


@pytest.fixture
def paths(tmp_path):
    return [str(tmp_path / n) for n in ("in", "out", "state")]


def _put(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def _latest(spark, paths, files=1):
    stream = upkeep.file_stream(spark, paths[0], spark.createDataFrame([], ROWS).schema, files)
    upkeep.keep_latest(stream, paths[1], paths[2], "k", missing_last("day", "id"), ["day", "id", "x"]).awaitTermination()
    return sorted(map(tuple, upkeep.latest(spark, paths[1], "k").selectExpr("k", "id", "x").collect()), key=str)


def test_latest_rows_follow_the_files(spark, paths):
    from datetime import date

    day = lambda d: date(2024, 1, d)
    slices = [
        [("a", day(3), 1, 1.0), ("b", day(1), 2, 2.0)],
        [("a", day(2), 3, 3.0), (None, day(1), 9, 9.0)],  # late: changes nothing
        [("a", day(3), 4, 4.0), ("b", None, 5, 5.0)],  # a missing day is the latest
    ]
    _put(spark, slices[0], ROWS, paths[0])
    assert _latest(spark, paths) == [("a", 1, 1.0), ("b", 2, 2.0)]
    for rows in slices[1:]:
        _put(spark, rows, ROWS, paths[0])
    expected = [("a", 4, 4.0), ("b", 5, 5.0), (None, 9, 9.0)]
    assert _latest(spark, paths) == sorted(expected, key=str)
    _put(spark, slices[0], ROWS, paths[0])
    assert _latest(spark, paths) == sorted(expected, key=str)
    assert _latest(spark, paths) == sorted(expected, key=str)  # no new files


def test_events_count_once_however_often_they_arrive(spark, paths):
    schema = "id long, ts timestamp, k string, x double"

    def run():
        stream = upkeep.file_stream(spark, paths[0], spark.createDataFrame([], schema).schema, 1)
        by, sums = {"k": F.col("k")}, {"n": F.count(F.lit(1)), "x": F.sum("x")}
        upkeep.keep_totals(stream, paths[1], paths[2], "id", "ts", "1 day", by, sums).awaitTermination()
        return {r["k"]: (r["n"], r["x"]) for r in upkeep.totals(spark, paths[1], ["k"]).collect()}

    from datetime import datetime

    at = lambda d, h=0: datetime(2024, 1, d, h)
    first = [(1, at(1), "a", 1.0), (2, at(1, 5), "b", 2.0), (2, at(1, 5), "b", 2.0)]
    second = [(3, at(9), "a", 4.0), (4, at(9, 1), "a", 8.0)]
    _put(spark, first, schema, paths[0])
    _put(spark, second, schema, paths[0])
    assert run() == {"a": (3, 13.0), "b": (1, 2.0)}
    _put(spark, first, schema, paths[0])  # older than the watermark
    _put(spark, second, schema, paths[0])  # known by their ids
    assert run() == {"a": (3, 13.0), "b": (1, 2.0)}


def test_a_batch_that_runs_again_writes_the_same_place(spark, paths):
    _put(spark, [("a", None, 1, 1.0)], ROWS, paths[0])
    _latest(spark, paths)
    commits = os.path.join(paths[2], "commits")
    for name in os.listdir(commits):
        if name.strip(".").startswith("0"):
            os.unlink(os.path.join(commits, name))
    assert _latest(spark, paths) == [("a", 1, 1.0)]
    assert [n for n in os.listdir(paths[1]) if n.startswith(upkeep.BATCH)] == [f"{upkeep.BATCH}=0"]
