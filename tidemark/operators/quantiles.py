"""Exact quantiles with linear interpolation, for any number of rows.

``percentile`` would keep every distinct value in one task. These scans shuffle only the few values near the answer:

1. a quantile sketch gives a bracket around every wanted rank;
2. one scan counts the rows below and inside each bracket, which proves that the bracket holds
   the rank (if not, it is widened);
3. the values inside the brackets are grouped with their counts, so a value shared by very many
   rows is one row, range partitioned, and the wanted ranks are looked up in the ordered counts.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import PART, range_parts

Wanted = dict[str, list[float]]


def exact_quantiles(
    df: DataFrame,
    wanted: Wanted,
    accuracy: int = 10_000,
    partitions: int | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles per column, missing values skipped; ``None`` for a column without values.

    ``df`` is read several times: pass a stored or staged table.
    """
    numbers = df.select([F.col(c).cast("double").alias(c) for c in wanted])
    numbers = numbers.select([F.when(~F.isnan(c), F.col(c)).alias(c) for c in wanted])
    return _by_brackets(numbers, wanted, accuracy, partitions)


def _by_brackets(
    numbers: DataFrame, wanted: Wanted, accuracy: int, partitions: int | None
) -> dict[str, list[float | None]]:
    sketch = numbers.agg(
        *[F.count(c).alias(f"n_{c}") for c in wanted],
        *[F.min(c).alias(f"min_{c}") for c in wanted],
        *[F.max(c).alias(f"max_{c}") for c in wanted],
        *[
            F.percentile_approx(
                c,
                F.array(*[F.lit(min(max(p + side, 0.0), 1.0)) for p in ps for side in _margins(accuracy)]),
                accuracy,
            ).alias(f"sketch_{c}")
            for c, ps in wanted.items()
        ],
    ).first()

    targets = []
    for column, ps in wanted.items():
        n = sketch[f"n_{column}"]
        if n == 0:
            continue
        low_margin = _margins(accuracy)[1]
        for i, p in enumerate(ps):
            low, high = sketch[f"sketch_{column}"][2 * i : 2 * i + 2]
            position = (n - 1) * p
            targets.append(
                {
                    "column": column,
                    "index": i,
                    "position": position,
                    "ranks": (math.floor(position) + 1, math.ceil(position) + 1),
                    "low": sketch[f"min_{column}"] if p <= low_margin else low,
                    "high": sketch[f"max_{column}"] if p >= 1 - low_margin else high,
                }
            )
    if not targets:
        return {c: [None] * len(ps) for c, ps in wanted.items()}
    _prove_brackets(numbers, targets, sketch)

    inside = [F.col(t["column"]).between(t["low"], t["high"]) for t in targets]
    hits = F.array(
        *[
            F.when(hit, F.struct(F.lit(b).alias("bracket"), F.col(t["column"]).alias("value")))
            for b, (t, hit) in enumerate(zip(targets, inside))
        ]
    )
    histogram = (
        numbers.filter(reduce(or_, inside))  # few rows are left to expand
        .select(F.explode(hits).alias("v"))
        .filter("v IS NOT NULL")
        .groupBy("v.bracket", "v.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ordered = range_parts(histogram, F.col("bracket"), F.col("value"), partitions=partitions)
    values = _values_at(ordered, targets)

    result: dict[str, list[float | None]] = {c: [None] * len(ps) for c, ps in wanted.items()}
    for b, t in enumerate(targets):
        first, last = (values[(b, rank)] for rank in t["ranks"])
        below, above = t["position"] - math.floor(t["position"]), math.ceil(t["position"]) - t["position"]
        result[t["column"]][t["index"]] = first if first == last else above * first + below * last
    return result


def _margins(accuracy: int) -> tuple[float, float]:
    return -2.0 / accuracy, 2.0 / accuracy


def _prove_brackets(numbers: DataFrame, targets: list[dict], sketch) -> None:
    """Count rows below and inside each bracket; a bracket that misses its ranks becomes min to max."""
    pending = list(range(len(targets)))
    while pending:
        checks = []
        for b in pending:
            t = targets[b]
            value = F.col(t["column"])
            checks.append(F.count(F.when(value < t["low"], 1)).alias(f"below_{b}"))
            checks.append(F.count(F.when(value <= t["high"], 1)).alias(f"upto_{b}"))
        counts = numbers.agg(*checks).first()
        missed = []
        for b in pending:
            t = targets[b]
            t["below"] = counts[f"below_{b}"]
            if not (t["below"] < t["ranks"][0] and t["ranks"][1] <= counts[f"upto_{b}"]):
                t["low"], t["high"] = sketch[f"min_{t['column']}"], sketch[f"max_{t['column']}"]
                missed.append(b)
        pending = missed


def _values_at(ordered: DataFrame, targets: list[dict]) -> dict[tuple[int, int], float]:
    """Value at each wanted rank, from the ordered (bracket, value, count) table."""
    sizes = ordered.groupBy("bracket", PART).agg(F.sum("n").alias("n")).orderBy("bracket", PART)
    lookups = []
    passed = {b: t["below"] for b, t in enumerate(targets)}
    for size in sizes.collect():  # one row per bracket and partition
        b = size["bracket"]
        for rank in sorted(set(targets[b]["ranks"])):
            if passed[b] < rank <= passed[b] + size["n"]:
                lookups.append((b, rank, size[PART], rank - passed[b]))
        passed[b] += size["n"]
    wanted_parts = reduce(or_, [(F.col("bracket") == b) & (F.col(PART) == part) for b, _, part, _ in lookups])
    running = F.sum("n").over(
        Window.partitionBy("bracket", PART).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    )
    row = (
        ordered.filter(wanted_parts)
        .withColumn("upto", running)
        .agg(
            *[
                F.min(
                    F.when(
                        (F.col("bracket") == b) & (F.col(PART) == part) & (F.col("upto") >= local),
                        F.col("value"),
                    )
                ).alias(f"v{i}")
                for i, (b, _, part, local) in enumerate(lookups)
            ]
        )
        .first()
    )
    return {(b, rank): row[f"v{i}"] for i, (b, rank, _, _) in enumerate(lookups)}
