import os
from datetime import date

import pytest
from pyspark.sql import types as T
from pyspark.sql import functions as F

from tidemark.schemas import BUSINESS
from tidemark.sources import readers, sinks, staging, views


def test_missing_and_empty_files_are_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.load_table(spark, str(tmp_path / "absent.csv"), BUSINESS["usage"])
    empty = tmp_path / "empty.csv"
    empty.write_text("CustomerID,Month,Logins,ActiveUsers,APICalls,SessionMinutes\n")
    with pytest.raises(ValueError, match="empty"):
        readers.load_table(spark, str(empty), BUSINESS["usage"])


def test_csv_scan_missing_values(spark, tmp_path):
    path = tmp_path / "usage.csv"
    path.write_text(
        "CustomerID,Month,Logins,ActiveUsers,APICalls,SessionMinutes\n"
        "C1,2024-01-01,3,2.5,10,NaN\nNA,2024-02-01,,,7,1.5\n"
    )
    loaded = readers.load_tables(spark, {"usage": str(path)})["usage"]
    first, second = sorted(loaded.collect(), key=lambda r: r["Month"])
    assert (first["CustomerID"], first["Month"], first["Logins"], first["SessionMinutes"]) == ("C1", "2024-01-01", 3, None)
    assert (second["CustomerID"], second["ActiveUsers"], second["APICalls"]) == (None, None, 7)
    typed = readers.load_tables(spark, {"usage": str(path)}, raw=False)["usage"]
    assert typed.schema["Month"].dataType.simpleString() == "date"
    inferred = readers.read_csv(spark, str(path))
    assert dict(inferred.dtypes)["ActiveUsers"] == "double"


def test_observed_counts_ride_along(spark, tmp_path):
    df, seen = readers.observed(spark.range(17).toDF("n"), "shape")
    df.write.parquet(str(tmp_path / "out"))
    assert seen.get["rows"] == 17
    shape = readers.table_shapes({"t": df}).collect()
    assert [(r["TableName"], r["Rows"], r["Columns"]) for r in shape] == [("t", 17, 1)]


def test_date_and_number_parsing(spark):
    df = spark.createDataFrame([("2024-02-29", "1.5"), ("nope", "x"), (None, None), ("2024-02-30", "NaN")], "d string, n string")
    found = [(r["a"], r["b"]) for r in df.select(readers.try_parse_date("d").alias("a"), readers.try_parse_number("n").alias("b")).collect()]
    assert found == [(date(2024, 2, 29), 1.5), (None, 0.0), (None, 0.0), (None, 0.0)]
    assert df.filter("d IS NULL").select(readers.parse_date("d")).first()[0] is None
    with pytest.raises(Exception, match="not a date: nope"):
        df.filter("d = 'nope'").select(readers.parse_date("d")).collect()


def test_staging_uses_the_shared_folder_of_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    df = staging.staged(spark.range(5).withColumn("x", F.lit(None).cast("date")))
    assert df.inputFiles() and all(f"{base}/stage-" in f for f in df.inputFiles())
    assert df.count() == 5 and dict(df.dtypes) == {"id": "bigint", "x": "date"}


def test_staging_freezes_values(spark):
    df = staging.staged(spark.range(100).withColumn("r", F.rand()))
    assert df.collect() == df.collect()


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_report_tables(spark, tmp_path, fmt):
    tables = {"a": spark.range(3).toDF("n"), "b": spark.range(4).toDF("m")}
    paths = sinks.write_reports(tables, str(tmp_path), fmt)
    assert set(paths) == {"a", "b"}
    reader = spark.read.option("header", True).format(fmt)
    assert (reader.load(paths["a"]).count(), reader.load(paths["b"]).columns) == (3, ["m"])


def test_partitioned_report_is_pruned(spark, tmp_path):
    df = spark.range(20).select("id", (F.col("id") % 4).alias("month"))
    sinks.write_report(df, str(tmp_path / "p"), partition_by=["month"])
    plan = spark.read.parquet(str(tmp_path / "p")).filter("month = 2")
    assert plan.count() == 5
    assert "PartitionFilters: [isnotnull(month" in plan._jdf.queryExecution().executedPlan().toString()


def test_views(spark):
    views.register_views({"customers": spark.range(2).toDF("CustomerID")})
    assert spark.sql("SELECT count(*) FROM customers").first()[0] == 2


FIELDS = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("hours", T.DoubleType()), T.StructField("note", T.StringType())]
)


def _csv(tmp_path, text):
    path = tmp_path / "table.csv"
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize(
    "text",
    [
        'id,hours,note\n1,2.5,"He said ""x"", ok"\n2,NA,"two\nlines"\n',
        'note,id,extra,hours\n"He said ""x"", ok",1,z,2.5\n"two\nlines",2,,\n',
    ],
)
def test_csv_columns_go_by_name(spark, tmp_path, text):
    found = readers.read_csv(spark, _csv(tmp_path, text), FIELDS).collect()
    assert [tuple(r) for r in found] == [(1, 2.5, 'He said "x", ok'), (2, None, "two\nlines")]


def test_csv_without_a_column_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="hours"):
        readers.read_csv(spark, _csv(tmp_path, "id,note\n1,a\n"), FIELDS)


def test_csv_text_in_a_number_column_raises(spark, tmp_path):
    df = readers.read_csv(spark, _csv(tmp_path, "id,hours,note\n1,bad,a\n"), FIELDS)
    with pytest.raises(Exception, match="hours: not a double: bad"):
        df.collect()


def test_nan_is_missing_in_every_format(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1, float("nan"), "a")], FIELDS).write.parquet(path)
    assert readers.load_table(spark, path, fmt="parquet").first()["hours"] is None


def test_staged_tables_go_with_their_block(spark):
    folder = staging.shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with staging.released(spark):
        assert staging.staged(spark.range(5)).count() == 5
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before
