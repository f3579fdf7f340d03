import random

import numpy as np
import pytest

from tidemark.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def _cases():
    pick = random.Random(3)
    return {
        "uniform": [pick.random() for _ in range(5000)],
        "heavy_tail": [pick.paretovariate(0.5) for _ in range(5000)],
        "third_equal": [42.0] * 2000 + [pick.gauss(42, 5) for _ in range(4000)],
        "few_values": [float(pick.randint(0, 3)) for _ in range(3000)],
        "constant": [7.5] * 500,
        "two": [1.0, 2.0],
        "one": [3.25],
        "with_missing": [None if i % 3 == 0 else float(i) for i in range(1000)],
        "none": [None, None],
    }


@pytest.mark.parametrize("name", list(_cases()))
def test_matches_linear_interpolation(spark, name):
    values = _cases()[name]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    found = exact_quantiles(df, {"x": PROBABILITIES}, accuracy=200, partitions=4)["x"]
    present = [v for v in values if v is not None]
    if not present:
        assert found == [None] * len(PROBABILITIES)
    else:
        assert found == pytest.approx(list(np.percentile(present, [p * 100 for p in PROBABILITIES])), rel=1e-12)


def test_equals_percentile_to_the_bit_on_several_columns(spark):
    pick = random.Random(11)
    rows = [(pick.gauss(0, 1), pick.randint(0, 50), None if i % 7 else 1.0) for i in range(4000)]
    df = spark.createDataFrame(rows, "a double, b int, c double")
    wanted = {"a": [0.25, 0.75], "b": [0.5], "c": [0.1, 0.9]}
    plain = df.selectExpr(*[f"percentile({c}, array({', '.join(map(str, ps))})) AS {c}" for c, ps in wanted.items()]).first()
    assert exact_quantiles(df, wanted, accuracy=100) == {c: list(plain[c]) for c in wanted}


def test_a_bracket_that_misses_its_rank_is_widened(spark):
    """A very coarse sketch gives wrong brackets; counting must notice."""
    values = [float(i**3) for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(8)
    found = exact_quantiles(df, {"x": [0.33, 0.66]}, accuracy=2000)["x"]
    assert found == pytest.approx(list(np.percentile(values, [33, 66])))


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (float("nan"),)], "x double")
    assert exact_quantiles(df, {"x": [0.25]})["x"] == [1.75]
