import csv
import random

import pytest
from pyspark.sql import types as T

from tidemark.sources import readers

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("b", "a")])


@pytest.fixture
def split(spark):
    """Files are split every so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")

    def to(size):
        for name in names:
            spark.conf.set(name, size)

    yield to
    for name in names:
        spark.conf.unset(name)


def _write(path, rows, end="\n", header=("a", "b")):
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(header)
        writer.writerows(rows)


def _random_rows(n, seed):
    rng = random.Random(seed)
    text = lambda: "x" + "".join(rng.choices('ab,"\n é', k=rng.randrange(12)))
    return [(text(), text()) for _ in range(n)]


def _found(spark, path):
    return sorted((r["a"], r["b"]) for r in readers.read_csv(spark, str(path), SCHEMA).collect())


@pytest.mark.parametrize("size", [25, 200, 10**6])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_do_not_depend_on_the_ranges(spark, split, tmp_path, size, end):
    rows = _random_rows(25, size)
    _write(tmp_path / "t.csv", rows, end)
    split(size)
    assert _found(spark, tmp_path / "t.csv") == sorted(rows)


def test_long_quoted_text_reaches_over_many_ranges(spark, split, tmp_path):
    rows = [("x", "line\n" * 200), ('q"' * 50, "\n\n\n"), ("y", "z"), ("v", "a\n" * 90)]
    _write(tmp_path / "t.csv", rows)
    split(150)
    assert _found(spark, tmp_path / "t.csv") == sorted(rows)


def test_folder_of_files(spark, split, tmp_path):
    (tmp_path / "t").mkdir()
    rows = _random_rows(90, 5)
    for i in range(3):
        _write(tmp_path / "t" / f"{i}.csv", rows[i * 30 : i * 30 + 30])
    split(100)
    assert _found(spark, tmp_path / "t") == sorted(rows)


def test_one_file_is_read_by_many_tasks(spark, split, tmp_path):
    _write(tmp_path / "t.csv", [(f"a{i}", 'two\nlines "quoted"') for i in range(4000)])
    split(10_000)
    df = readers.read_csv(spark, str(tmp_path / "t.csv"), SCHEMA)
    assert df.rdd.getNumPartitions() > 8
    assert df.count() == 4000
    plan = df._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Union")[-1].split("MapInArrow")[0]
    assert "Exchange" not in main


def test_other_header_is_an_error(spark, tmp_path):
    (tmp_path / "t").mkdir()
    _write(tmp_path / "t" / "1.csv", [("x", "y")])
    _write(tmp_path / "t" / "2.csv", [("x", "y")], header=("a", "c"))
    with pytest.raises(Exception, match="another header|no column"):
        readers.read_csv(spark, str(tmp_path / "t"), SCHEMA).collect()


def test_empty_lines_and_no_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n\n1,\n\r\n,2\n")
    found = [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "t.csv"), SCHEMA).collect()]
    assert sorted(found, key=str) == [("2", None), (None, "1")]
    (tmp_path / "e.csv").write_text("a,b")
    assert readers.read_csv(spark, str(tmp_path / "e.csv"), SCHEMA).count() == 0


def test_rejects_are_set_aside(spark, tmp_path):
    schema = T.StructType(
        [T.StructField("k", T.StringType()), T.StructField("d", T.DateType()), T.StructField("x", T.DoubleType())]
    )
    rows = [("1", "2024-01-31", "1.5"), ("2", "2024-02-30", "2"), ("3", "soon", "n.a."), ("4", "", "NaN"), ("5", "2024-01-01", "7\n8")]
    _write(tmp_path / "t.csv", rows, header=("k", "d", "x"))
    loaded = readers.load_with_rejects(spark, str(tmp_path / "t.csv"), schema)
    assert loaded.counts == {"accepted": 2, "rejected": 3}
    assert {r["k"]: (r["d"], r["x"]) for r in loaded.rejected.collect()} == {r[0]: r[1:] for r in rows if r[0] in "235"}
    assert {r["k"]: r["Reasons"] for r in loaded.rejected.collect()} == {
        "2": "d: not a date", "3": "d: not a date; x: not a double", "5": "x: not a double"
    }
    assert loaded.accepted.schema == schema
    assert {r["k"]: (str(r["d"]), r["x"]) for r in loaded.accepted.collect()} == {"1": ("2024-01-31", 1.5), "4": ("None", None)}
    with pytest.raises(Exception, match="not a date"):
        readers.read_csv(spark, str(tmp_path / "t.csv"), schema).collect()


def test_rejects_of_an_empty_table(spark, tmp_path):
    _write(tmp_path / "t.csv", [])
    loaded = readers.load_with_rejects(spark, str(tmp_path / "t.csv"), SCHEMA)
    assert loaded.counts == {"accepted": 0, "rejected": 0}
    assert loaded.accepted.count() == loaded.rejected.count() == 0
