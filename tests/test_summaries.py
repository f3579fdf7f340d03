import math
import random

import numpy as np
import pytest

from tidemark.operators import summaries


def test_population_and_sample_deviation(spark, rows):
    df = spark.createDataFrame([(1.0, 1), (2.0, 2), (4.0, None)], "a double, b int")
    stats = {r["Metric"]: r for r in summaries.metric_stats([(df, ["a", "b"])]).collect()}
    described = {r["Metric"]: r for r in summaries.describe([(df, ["a", "b"])]).collect()}
    assert stats["a"]["Std"] == round(np.std([1, 2, 4]), 2) and stats["a"]["Mean"] == 2.33
    assert described["a"]["std"] == pytest.approx(np.std([1, 2, 4], ddof=1))
    assert (described["b"]["count"], described["b"]["q50"], described["b"]["max"]) == (2, 1.5, 2.0)


def test_tables_of_different_length_are_described_together(spark):
    short = spark.createDataFrame([(1.0,)], "a double")
    long = spark.createDataFrame([(float(i),) for i in range(9)], "b double")
    assert {r["Metric"]: r["count"] for r in summaries.describe([(short, ["a"]), (long, ["b"])]).collect()} == {"a": 1, "b": 9}


def test_correlation_skips_pairs_with_a_missing_value(spark):
    pick = random.Random(5)
    data = [(float(i), i * 2.0 + pick.random(), None if i % 4 == 0 else pick.random()) for i in range(60)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    found = {(r["MetricA"], r["MetricB"]): r["Correlation"] for r in summaries.correlation_long(df, ["a", "b", "c"]).collect()}
    assert len(found) == 9 and found[("a", "a")] == pytest.approx(1.0)
    kept = [(a, c) for a, _, c in data if c is not None]
    assert found[("a", "c")] == pytest.approx(np.corrcoef(*zip(*kept))[0, 1])
    assert found[("a", "c")] == pytest.approx(found[("c", "a")])
    matrix = {r["Metric"]: r for r in summaries.correlation_matrix(df, ["a", "b"]).collect()}
    assert matrix["a"]["b"] == pytest.approx(np.corrcoef([d[0] for d in data], [d[1] for d in data])[0, 1])


def test_histogram_closes_the_last_bin_and_keeps_empty_ones(spark, rows):
    values = [0.0, 0.1, 9.99, 10.0, 10.0 - 1e-9, 5.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    found = sorted(rows(summaries.histogram(df, "x", 10)), key=lambda r: r["Bin"])
    assert [r["Records"] for r in found] == list(np.histogram(values, bins=10)[0])
    assert found[0]["BinStart"] == 0.0 and found[-1]["BinEnd"] == 10.0
    same = spark.createDataFrame([(4.0,)] * 3, "x double")
    assert sum(r["Records"] for r in summaries.histogram(same, "x", 4).collect()) == 3


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, k double")
    assert [r["s"] for r in summaries.min_max_scaled(df, "a", "s").orderBy("a").collect()] == [0.0, 0.333, 1.0]
    assert {r["s"] for r in summaries.min_max_scaled(df, "k", "s").collect()} == {None}
    scaled = summaries.standardised(df, ["a", "k"]).orderBy("a").collect()
    assert [r["kScaled"] for r in scaled] == [0.0, 0.0, 0.0]
    assert math.isclose(sum(r["aScaled"] ** 2 for r in scaled), 3.0)


def test_iqr_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    found = {r["x"]: r["Outlier"] for r in summaries.iqr_outliers(df, "x").collect()}
    assert found == {1.0: False, 2.0: False, 3.0: False, 4.0: False, 100.0: True, None: False}
    nothing = spark.createDataFrame([(None,)], "x double")
    assert [r["Outlier"] for r in summaries.iqr_outliers(nothing, "x").collect()] == [False]
