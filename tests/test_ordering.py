import random

import pytest

from tidemark.operators.ordering import rank_descending


def _expected(values):
    present = [v if v is not None else float("-inf") for v in values]
    return [1 + sum(other > v for other in present) for v in present]


CASES = {
    "tied": [5.0, 5.0, 3.0],
    "third_equal": [7.0] * 400 + [float(random.Random(i).randint(0, 1000)) for i in range(800)],
    "all_equal": [1.0] * 300,
    "with_missing": [None, 4.0, None, 9.0, 4.0],
    "distinct": [float(i) for i in range(500)],
    "two_hot": [2.0] * 300 + [1.0] * 300 + [1.5],
    "one": [1.0],
}


@pytest.mark.parametrize("name", list(CASES))
def test_rank_with_gaps(spark, name):
    values = CASES[name]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    ranked = rank_descending(df, "v", "id", "rank", partitions=6)
    assert ranked.columns == ["id", "v", "rank"]
    found = {r["id"]: r["rank"] for r in ranked.collect()}
    assert [found[i] for i in range(len(values))] == _expected(values)


NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize(
    "kind, values",
    [
        ("double", [NAN] * 6 + [1.0, None]),
        ("double", [1.0, -INF, None, None, -INF, INF, NAN, 0.0, -0.0]),
        ("bigint", [2**53, 2**53 + 1, 2**53 + 2, None, 2**53 + 1]),
        ("decimal(30,2)", ["10000000000000000000.01", "10000000000000000000.02", None, "10000000000000000000.02"]),
        ("date", ["2020-01-02", None, "2020-01-01", "2020-01-02"]),
        ("string", ["b", "a", None, "b", "é"]),
    ],
)
@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_rank_equals_the_window_for_every_type(spark, kind, values, partitions):
    text = kind not in ("double", "bigint")
    df = spark.createDataFrame(list(enumerate(values)), f"id long, v {'string' if text else kind}")
    df = df.withColumn("v", df["v"].cast(kind))
    window = df.selectExpr("id", "rank() OVER (ORDER BY v DESC NULLS LAST) AS r").collect()
    found = rank_descending(df, "v", "id", "r", partitions=partitions).collect()
    assert {r["id"]: r["r"] for r in found} == {r["id"]: r["r"] for r in window}


def test_large_tie_spreads_over_partitions(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.ordering import PART, range_parts

    df = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") * 1.0).alias("v"))
    sizes = range_parts(df, F.col("v").desc(), F.col("id"), partitions=8).groupBy(PART).count().collect()
    assert len(sizes) == 8
    assert max(s["count"] for s in sizes) < 2000
