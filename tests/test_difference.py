from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators.difference import differing_ranges, table_difference

SCHEMA = "k int, x string, y double"


def _brute(before, after):
    gone, come = Counter(before) - Counter(after), Counter(after) - Counter(before)
    was, now = {r[0] for r in gone}, {r[0] for r in come}
    out = [(*r, "changed from" if r[0] in now else "removed", n) for r, n in gone.items()]
    return sorted(out + [(*r, "changed to" if r[0] in was else "added", n) for r, n in come.items()], key=str)


def _found(spark, before, after, **options):
    a, b = spark.createDataFrame(before, SCHEMA), spark.createDataFrame(after, SCHEMA)
    return sorted(map(tuple, table_difference(a, b, "k", **options).collect()), key=str)


ROWS = [(i, "a" if i % 3 else None, float(i)) for i in range(40)] + [(1, "twice", 1.0)] * 2 + [(None, "none", None)] * 3


@pytest.mark.parametrize("ranges", [None, "floor(k / 10)"])
def test_equals_multiset_difference(spark, ranges):
    after = [r for r in ROWS if r[0] != 7] + [(1, "twice", 1.0), (99, "new", 0.5), (99, "new", 0.5)]
    after = [(r[0], "b", r[2]) if r[0] == 12 else r for r in after]
    after.remove((None, "none", None))
    assert _found(spark, ROWS, after, ranges=ranges and F.expr(ranges)) == _brute(ROWS, after)


def test_order_does_not_matter_and_equal_runs_differ_nowhere(spark):
    assert _found(spark, ROWS, ROWS[::-1]) == []
    assert _found(spark, [], []) == []
    assert _found(spark, ROWS, []) == _brute(ROWS, [])


def test_only_differing_ranges_are_compared(spark):
    before = spark.range(10_000).selectExpr("id AS k", "id * 2 AS x")
    after = before.withColumn("x", F.when(F.col("k") == 4321, -1).otherwise(F.col("x")))
    ranges = F.floor(F.col("k") / 100)
    assert [r[0] for r in differing_ranges(before, after, ranges, ["k", "x"]).collect()] == [43]
    found = table_difference(before, after, "k", ranges).collect()
    assert sorted((r["k"], r["x"], r["Change"]) for r in found) == [(4321, -1, "changed to"), (4321, 8642, "changed from")]


def test_swapped_values_are_seen(spark):
    before, after = [(1, "ab", 1.0), (2, "c", 2.0)], [(1, "a", 1.0), (2, "bc", 2.0)]
    assert _found(spark, before, after, ranges=F.lit(0)) == _brute(before, after)
    assert _found(spark, [(1, None, 2.0)], [(1, "", 2.0)]) == _brute([(1, None, 2.0)], [(1, "", 2.0)])


def test_other_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="different columns"):
        table_difference(spark.range(1), spark.range(1).toDF("x"), "id")
