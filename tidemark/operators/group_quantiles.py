"""Exact quantiles of every group, with linear interpolation, for any number and any size of groups.

The brackets of ``quantiles`` become a table keyed by group: a sketch per group brackets its ranks, a count proves the
brackets, and only the distinct values inside are ordered. A group with a large part of all rows is folded by each task
before the shuffle, and its values inside a bracket are range partitioned like all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.running import running_sums
from tidemark.sources.staging import staged


def group_quantiles(
    df: DataFrame, group: str, column: str, ps: dict[str, float], accuracy: int = 10_000, partitions: int | None = None
) -> DataFrame:
    """One row per group (a missing one is a group) with each quantile of ``ps`` (name: share); missing values skipped.

    A group without values has missing quantiles. ``df`` is read three times: pass a stored or staged table.
    """
    value = F.col(column).cast("double")
    rows = df.select(F.col(group).alias("_group"), F.when(~F.isnan(value), value).alias("_value"))
    brackets = _proven(rows, staged(_brackets(rows, list(ps.values()), accuracy), "brackets"), len(ps))
    inside = (
        _met(rows, brackets)
        .filter("_value IS NOT NULL")
        .select("_group", "_value", F.explode("_brackets").alias("b"))
        .filter("_value BETWEEN b.low AND b.high")
        .groupBy("_group", F.col("b.i").alias("i"), "_value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = running_sums(inside, ["_group", "i"], ["_value"], {"upto": "n"}, partitions)
    flat = brackets.select("_group", F.explode("_brackets").alias("b"))
    flat = flat.select("_group", "b.i", "b.below", "b.position")
    met = upto.alias("v").join(
        flat.alias("b"), F.col("v._group").eqNullSafe(F.col("b._group")) & (F.col("v.i") == F.col("b.i"))
    )
    rank = F.col("b.below") + F.col("v.upto")
    at = lambda wanted: F.min(F.when(rank >= wanted + 1, F.col("v._value")))
    low, high = F.floor("b.position"), F.ceil("b.position")
    found = met.groupBy(F.col("b._group").alias("_group"), F.col("b.i").alias("i")).agg(
        at(low).alias("first"), at(high).alias("last"), (F.first("b.position") - F.first(low)).alias("part")
    )
    between = F.when(F.col("first") == F.col("last"), F.col("first")).otherwise(
        F.col("first") * (1 - F.col("part")) + F.col("last") * F.col("part")
    )
    wide = found.groupBy("_group").agg(*[F.max(F.when(F.col("i") == i, between)).alias(name) for i, name in enumerate(ps)])
    every = brackets.select("_group").alias("g").join(wide.alias("q"), F.col("g._group").eqNullSafe(F.col("q._group")), "left")
    return every.select(F.col("g._group").alias(group), *[F.col(f"q.{name}") for name in ps])


def _brackets(rows: DataFrame, ps: list[float], accuracy: int) -> DataFrame:
    """Per group its values' number, and for each share a bracket of values around the wanted rank."""
    side = 2.0 / accuracy
    shares = F.array(*[F.lit(min(max(p + s, 0.0), 1.0)) for p in ps for s in (-side, side)])
    sketch = rows.groupBy("_group").agg(
        F.count("_value").alias("n"),
        F.min("_value").alias("least"),
        F.max("_value").alias("most"),
        F.percentile_approx("_value", shares, accuracy).alias("q"),
    )

    def bracket(i: int, p: float) -> Column:
        # Near its ends the sketch may miss by a rank: there the bracket goes on to the end.
        low = F.when(F.lit(p <= side), F.col("least")).otherwise(F.col("q")[2 * i])
        high = F.when(F.lit(p >= 1 - side), F.col("most")).otherwise(F.col("q")[2 * i + 1])
        position = (F.col("n") - 1) * F.lit(p)
        return F.struct(F.lit(i).alias("i"), low.alias("low"), high.alias("high"), position.alias("position"))

    made = F.array(*[bracket(i, p) for i, p in enumerate(ps)])
    return sketch.select("_group", "least", "most", F.when(F.col("n") > 0, made).alias("_brackets"))


def _met(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    """Rows with the brackets of their group. Groups are unique there; a large group's rows are split at run time."""
    other = brackets.withColumnRenamed("_group", "_other")
    return rows.join(other, F.col("_group").eqNullSafe(F.col("_other"))).drop("_other")


def _proven(rows: DataFrame, brackets: DataFrame, width: int) -> DataFrame:
    """Brackets with the number of values below; one that misses its ranks becomes least to most, with none below."""
    per_value = _met(rows.filter("_value IS NOT NULL"), brackets).select(
        "_group",
        F.transform("_brackets", lambda b: (F.col("_value") < b["low"]).cast("long")).alias("below"),
        F.transform("_brackets", lambda b: (F.col("_value") <= b["high"]).cast("long")).alias("upto"),
    )
    counts = per_value.groupBy("_group").agg(
        F.array(*[F.sum(F.col("below")[i]) for i in range(width)]).alias("below"),
        F.array(*[F.sum(F.col("upto")[i]) for i in range(width)]).alias("upto"),
    )
    joined = brackets.alias("k").join(
        counts.select(F.col("_group").alias("_other"), "below", "upto"), F.col("k._group").eqNullSafe(F.col("_other")), "left"
    )

    def proven(b: Column) -> Column:
        below, upto = F.col("below")[b["i"]], F.col("upto")[b["i"]]
        good = (below <= F.floor(b["position"])) & (F.ceil(b["position"]) + 1 <= upto)
        return F.struct(
            b["i"].alias("i"),
            F.when(good, b["low"]).otherwise(F.col("least")).alias("low"),
            F.when(good, b["high"]).otherwise(F.col("most")).alias("high"),
            b["position"].alias("position"),
            F.when(good, below).otherwise(F.lit(0)).alias("below"),
        )

    return staged(joined.select("_group", F.transform("_brackets", proven).alias("_brackets")), "proven")
