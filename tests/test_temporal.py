import bisect
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.running import running_sums
from tidemark.operators.temporal import active_by_day, as_of_join

DAY = date(2024, 1, 1)


def _as_of(left, right):
    out = []
    for key, day, n in left:
        states = sorted((d, i) for k, d, i in right if k == key and k is not None and d is not None)
        at = bisect.bisect_right(states, (day, 10**9)) if day is not None and key is not None else 0
        out.append((key, day, n, states[at - 1][1] if at else None))
    return sorted(out, key=str)


def _found(spark, left, right, **options):
    a = spark.createDataFrame(left, "k string, day date, n int")
    b = spark.createDataFrame(right, "k string, since date, id int")
    joined = as_of_join(a, b, "k", "day", "since", "id", ["id"], **options)
    assert joined.columns == ["k", "day", "n", "id"]
    return sorted(map(tuple, joined.collect()), key=str)


def _rows(seed, hot=400):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", None]
    day = lambda: None if rng.random() < 0.05 else DAY + timedelta(days=rng.randrange(90))
    left = [(rng.choice(keys), day(), i) for i in range(hot)]
    right = [(rng.choice(keys), day(), i) for i in range(hot // 3)]
    return left, right


@pytest.mark.parametrize("segment_rows", [10**6, 37, 5, 1])
def test_as_of_equals_brute_force_however_keys_are_cut(spark, segment_rows):
    left, right = _rows(segment_rows)
    assert _found(spark, left, right, segment_rows=segment_rows) == _as_of(left, right)


def test_state_is_carried_over_segments_without_states(spark):
    left = [("k", DAY + timedelta(days=i), i) for i in range(60)]
    right = [("k", DAY + timedelta(days=3), 1), ("k", DAY + timedelta(days=55), 2), ("other", DAY, 9)]
    found = _found(spark, left, right, segment_rows=6)
    assert [r[3] for r in sorted(found, key=lambda r: r[2])] == [None] * 3 + [1] * 52 + [2] * 5


def test_as_of_with_an_empty_side(spark):
    assert _found(spark, [], [("k", DAY, 1)]) == []
    assert _found(spark, [("k", DAY, 1)], []) == [("k", DAY, 1, None)]


def test_a_large_key_lies_in_many_groups(spark):
    left = spark.range(3000).select(F.lit("k").alias("k"), F.date_add(F.lit(DAY), F.col("id").cast("int") % 1000).alias("day"))
    right = left.limit(20).select("k", F.col("day").alias("since"), F.monotonically_increasing_id().alias("id"))
    joined = as_of_join(left, right, "k", "day", "since", "id", ["id"], segment_rows=100)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    window = next(line for line in plan.splitlines() if "Window [last(" in line)
    assert "_segment" in window
    assert joined.count() == 3000


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_running_sums(spark, partitions):
    rng = random.Random(partitions)
    rows = [(rng.choice(["hot"] * 5 + ["a", None]), i, rng.choice([None, 1, 2, 3])) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, o int, x int")
    grouped = running_sums(df, ["g"], ["o"], {"upto": "x"}, partitions)
    whole = running_sums(df, [], ["o"], {"upto": "x"}, partitions)
    for found, same in ((grouped, lambda a, b: a == b), (whole, lambda a, b: True)):
        expected = {o: sum(y or 0 for h, p, y in rows if same(g, h) and p <= o) for g, o, _ in rows}
        assert {r["o"]: r["upto"] or 0 for r in found.collect()} == expected


def test_active_by_day(spark):
    d = lambda i: DAY + timedelta(days=i)
    rows = [(d(0), d(3), 10.5), (d(1), None, 1.25), (d(5), d(5), 99.0), (d(6), d(4), 99.0), (None, d(3), 99.0), (d(8), d(9), None)]
    df = spark.createDataFrame(rows, "s date, e date, x double")
    for partitions in (None, 4):
        found = {r["Day"]: (r["Active"], r["Amount"]) for r in active_by_day(df, "s", "e", "x", partitions).collect()}
        expected = {}
        for i in range(10):
            on = [x or 0 for s, e, x in rows if s and s <= d(i) and (e is None or e > d(i)) and (e is None or e > s)]
            expected[d(i)] = (len(on), sum(on))
        assert found == expected
    assert active_by_day(df.limit(0), "s", "e", "x").count() == 0


def test_active_by_day_over_years(spark):
    rows = [(date(2019, 5, 1), date(2023, 2, 1), 1.0), (date(2021, 1, 1), None, 2.0)]
    found = {r["Day"]: r["Active"] for r in active_by_day(spark.createDataFrame(rows, "s date, e date, x double"), "s", "e", "x").collect()}
    assert len(found) == (date(2023, 2, 1) - date(2019, 5, 1)).days + 1
    assert (found[date(2020, 12, 31)], found[date(2021, 1, 1)], found[date(2023, 2, 1)]) == (1, 2, 1)
