import random

import numpy as np
import pytest

from tidemark.operators.group_quantiles import group_quantiles
from tidemark.operators.sketches import distinct_sketches, estimate, merged

SHARES = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q9": 0.9, "q10": 1.0}


def _expected(rows):
    groups = {}
    for g, x in rows:
        groups.setdefault(g, []).extend([] if x is None or x != x else [x])
    return {
        g: tuple(float(np.percentile(v, 100 * p)) if v else None for p in SHARES.values()) for g, v in groups.items()
    }


def _found(spark, rows, **options):
    df = spark.createDataFrame(rows, "g string, x double")
    found = group_quantiles(df, "g", "x", SHARES, **options)
    assert found.columns == ["g", *SHARES]
    return {r["g"]: tuple(r[c] for c in SHARES) for r in found.collect()}


def _same(found, expected):
    assert set(found) == set(expected)
    for g, values in expected.items():
        assert found[g] == pytest.approx(values) if values[0] is not None else found[g] == values


@pytest.mark.parametrize("accuracy,partitions", [(10_000, None), (20, 5), (3, 2)])
def test_equals_numpy_however_coarse_the_sketch(spark, accuracy, partitions):
    rng = random.Random(accuracy)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.choice([None, float("nan"), rng.gauss(0, 9), 7.0])) for _ in range(600)]
    _same(_found(spark, rows, accuracy=accuracy, partitions=partitions), _expected(rows))


def test_small_groups_and_groups_without_values(spark):
    rows = [("one", 3.0), ("two", 1.0), ("two", 2.0), ("none", None), ("same", 5.0), ("same", 5.0), ("same", 5.0)]
    _same(_found(spark, rows), _expected(rows))
    assert _found(spark, []) == {}


def test_nothing_is_collected_by_group(spark):
    df = spark.range(5000).selectExpr("cast(id % 997 as string) as g", "cast(id as double) as x")
    plan = group_quantiles(df, "g", "x", SHARES)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_sketches_of_parts_merge(spark):
    df = spark.range(60_000).selectExpr("id % 3 as part", "id % 20000 as x")
    parts = distinct_sketches(df, ["part"], "x")
    whole = merged(parts, []).select(estimate().alias("n")).first()["n"]
    assert abs(whole - 20_000) < 600
    assert merged(parts.unionByName(parts), []).select(estimate().alias("n")).first()["n"] == whole
    assert distinct_sketches(df.limit(0), ["part"], "x").count() == 0
