import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.gram import correlations
from tidemark.operators.lloyd import fit_all, starting_centres
from tidemark.operators.summaries import correlation_long


def test_correlations_equal_numpy_with_gaps_and_large_means(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4))
    x[:, 1] = x[:, 0] * 2 + x[:, 1] + 1e6
    x[:, 3] = 7.0
    gaps = rng.random((400, 4)) < 0.1
    rows = [tuple(None if g else float(v) for v, g in zip(r, h)) for r, h in zip(x, gaps)]
    rows.append((float("nan"), 1.0, 2.0, 3.0))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)
    found = {(r["a"], r["b"]): r["r"] for r in correlations(df.drop("d"), ["a", "b", "c"]).collect()}
    full = np.array([[np.nan if v is None else v for v in r] for r in rows])
    for i in range(3):
        for j in range(3):
            both = ~np.isnan(full[:, i]) & ~np.isnan(full[:, j])
            assert found[i, j] == pytest.approx(np.corrcoef(full[both, i], full[both, j])[0, 1], abs=1e-9)
    constant = df.withColumn("d", F.lit(7.0))
    assert correlations(constant, ["a", "d"]).filter("a = 1 OR b = 1").filter("r IS NOT NULL").count() == 0


def test_correlation_reads_rows_once_and_repeats_none(spark):
    df = spark.range(100).selectExpr("cast(id as double) a", "cast(id * id as double) b", "-id c")
    table = correlation_long(df, ["a", "b", "c"])
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan.split("AdaptiveSparkPlan")[0]
    found = {(r["MetricA"], r["MetricB"]): r["Correlation"] for r in table.collect()}
    assert found["a", "c"] == pytest.approx(-1) and found["b", "b"] == pytest.approx(1) and len(found) == 9


def test_no_rows_no_correlations(spark):
    assert correlations(spark.range(0).selectExpr("cast(id as double) a", "cast(id as double) b"), ["a", "b"]).count() == 0


def _points(spark, rows):
    return spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(rows)], "id long, v array<double>")


def _lloyd(points, centres, shift):
    """Plain Lloyd steps: the centres before the first step that moves them by no more than ``shift``, and their cost."""
    while True:
        apart = ((points[:, None, :] - centres[None]) ** 2).sum(2)
        label = apart.argmin(1)
        new = np.array([points[label == i].mean(0) if (label == i).any() else c for i, c in enumerate(centres)])
        if ((new - centres) ** 2).sum() <= shift:
            return centres, apart.min(1).sum()
        centres = new


def test_every_fit_is_the_fit_alone(spark):
    pick = random.Random(2)
    rows = np.array([[pick.gauss(c, 1), pick.gauss(-c, 1)] for c in (0, 5, 9) for _ in range(60)])
    points = _points(spark, rows).repartition(5)
    fits = fit_all(points, "v", "id", [2, 3, 4], 3, 7, 1e-4)
    assert set(fits) == {(k, i) for k in (2, 3, 4) for i in range(3)}
    order = points.orderBy(F.xxhash64("id"), "id").select("v").collect()
    sample = np.array([r["v"] for r in order])
    for (k, i), fit in fits.items():
        centres, cost = _lloyd(rows, starting_centres(sample, k, 7 + i), 1e-4)
        assert np.allclose(fit.centres, centres) and fit.cost == pytest.approx(cost)


def test_fewer_points_than_clusters(spark):
    fits = fit_all(_points(spark, [(1, 1), (1, 1), (2, 2)]), "v", "id", [4], 2, 1, 1e-4)
    assert all(f.cost == pytest.approx(0) for f in fits.values())
    assert fit_all(_points(spark, [(1, 1)]).limit(0), "v", "id", [2], 1, 1, 1e-4) == {}


def test_passes_are_shared(spark, monkeypatch):
    from tidemark.operators import lloyd

    seen = []
    one = lloyd._pass
    monkeypatch.setattr(lloyd, "_pass", lambda points, models: seen.append(len(models)) or one(points, models))
    pick = random.Random(5)
    rows = [(pick.random(), pick.random(), pick.random()) for _ in range(200)]
    fits = fit_all(_points(spark, rows), "v", "id", [2, 5], 4, 3, 1e-4)
    assert len(seen) == max(f.passes for f in fits.values()) and seen[0] == 8
