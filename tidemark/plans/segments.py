"""k-means customer segments: elbow table, segments named by their centres, summary."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.features import KEY
from tidemark.operators.lloyd import Fit, fit_all
from tidemark.operators.summaries import standardised
from tidemark.sources.staging import staged

FEATURES = ["MRR", "Seats", "Logins", "ActiveUsers", "SessionMinutes", "SatisfactionScore"]
#: A fit ends when the squared moves of all centres (in standard deviations) sum to at most this.
SQUARED_SHIFT = 1e-4

# The segment names.
HIGH_VALUE, GROWING, LOW, SUPPORT = "High Value", "Growing Users", "Low Engagement", "Support Heavy"


def vectors(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Features, staged in even partitions, with their standardised vector (an array)."""
    columns = columns or FEATURES
    scaled = standardised(staged(features.hint("rebalance"), "features"), columns)
    return staged(scaled.select(KEY, *columns, F.array(*[f"{c}Scaled" for c in columns]).alias("vector")), "vectors")


def best_fits(points: DataFrame, ks: list[int], restarts: int = 10, seed: int = 42) -> dict[int, Fit]:
    """For each number of clusters, the fit with the lowest cost over several starts. All fits share their passes."""
    best: dict[int, Fit] = {}
    for (k, _), fit in sorted(fit_all(points, "vector", KEY, ks, restarts, seed, SQUARED_SHIFT).items()):
        if k not in best or fit.cost < best[k].cost:
            best[k] = fit
    if not best:
        raise ValueError("there are no customers to cluster")
    return best


def elbow_cost(
    points: DataFrame, ks: range = range(2, 7), restarts: int = 10, fits: dict[int, Fit] | None = None
) -> DataFrame:
    """Lowest cost for each number of clusters, of ``fits`` if they are at hand."""
    fits = fits or best_fits(points, list(ks), restarts)
    return points.sparkSession.createDataFrame([(k, fits[k].cost) for k in ks], "K int, Cost double")


def squared_distances(centres: np.ndarray, vector: str = "vector") -> Column:
    """Array of the squared distances from a vector to each centre."""
    place = F.col(vector)
    return F.array(*[sum((place[i] - F.lit(float(c))) ** 2 for i, c in enumerate(centre)) for centre in centres])


def label(column: Column, names: dict[int, str]) -> Column:
    """Value from a dictionary; NULL when it has none."""
    entries = [F.lit(x) for pair in names.items() for x in pair]
    return F.create_map(*entries)[column]


def names_by_centre(fit: Fit, columns: list[str] | None = None) -> dict[int, str]:
    """Name four clusters by what their centres show; cluster numbers themselves mean nothing.

    Highest revenue is High Value; of the others the least satisfied is Support Heavy, and of the
    last two the one with more logins is Growing Users and the other Low Engagement.
    """
    columns = columns or FEATURES
    centres = [dict(zip(columns, centre)) for centre in fit.centres]
    left = list(range(len(centres)))
    names = {}
    for name, pick in (
        (HIGH_VALUE, lambda c: centres[c]["MRR"]),
        (SUPPORT, lambda c: -centres[c]["SatisfactionScore"]),
        (GROWING, lambda c: centres[c]["Logins"]),
        (LOW, lambda c: -centres[c]["Logins"]),
    ):
        if left:
            chosen = max(left, key=pick)
            names[chosen] = name
            left.remove(chosen)
    return names


def segments(
    features: DataFrame, restarts: int = 10, seed: int = 42, names: dict[int, str] | None = None
) -> DataFrame:
    """Customers with cluster number and segment name (four clusters)."""
    points = vectors(features)
    return segments_of(points, best_fits(points, [4], restarts, seed)[4], names)


def segments_of(points: DataFrame, fit: Fit, names: dict[int, str] | None = None) -> DataFrame:
    """As ``segments``, from vectors and a fit at hand; of equally near centres the first counts."""
    names = names or names_by_centre(fit)
    apart = squared_distances(fit.centres)
    return (
        points.withColumn("_apart", apart)
        .withColumn("Cluster", (F.array_position("_apart", F.array_min("_apart")) - 1).cast("int"))
        .withColumn("Segment", label(F.col("Cluster"), names))
        .drop("vector", "_apart")
    )


def segment_summary(segmented: DataFrame) -> DataFrame:
    return (
        segmented.filter("Segment IS NOT NULL")
        .groupBy("Segment")
        .agg(
            F.count(KEY).alias("Customers"),
            F.avg("MRR").alias("AvgMRR"),
            F.avg("Logins").alias("AvgLogins"),
        )
    )


def checks(features: DataFrame, ks: range = range(2, 7), restarts: int = 10) -> DataFrame:
    """One row of what must hold for the clusters, their names and their summary, whichever they are."""
    points = vectors(features)
    fits = best_fits(points, list(ks), restarts)
    fit, costs = fits[4], [fits[k].cost for k in ks]
    segmented = staged(segments_of(points, fit).join(points.select(KEY, "vector"), KEY), "segments")
    apart = squared_distances(fit.centres)
    own = F.get(apart, F.col("Cluster"))
    whole = segmented.agg(
        F.count(KEY).alias("Customers"),
        F.sum("MRR").alias("TotalMRR"),
        F.count_if(own > F.array_min(apart) * (1 + 1e-9) + 1e-9).alias("NotNearest"),
        (F.abs(F.sum(own) - F.lit(fit.cost)) <= 1e-6 * F.lit(fit.cost)).alias("CostAgrees"),
        F.lit(all(b <= a for a, b in zip(costs, costs[1:]))).alias("CostFalls"),
    )
    # A settled centre is the mean of its members, up to the moves that end a fit.
    means = segmented.groupBy("Cluster").agg(*[F.avg(F.col("vector")[i]).alias(f"m{i}") for i in range(len(FEATURES))])
    centre = F.get(F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in fit.centres]), F.col("Cluster"))
    off = means.agg((F.sum(sum((F.col(f"m{i}") - centre[i]) ** 2 for i in range(len(FEATURES)))) <= SQUARED_SHIFT).alias("CentresAreMeans"))
    summary = staged(segment_summary(segmented), "summary")
    totals = summary.agg(
        F.count(F.lit(1)).alias("Segments"),
        F.sum("Customers").alias("SummaryCustomers"),
        F.sum(F.col("Customers") * F.col("AvgMRR")).alias("SummaryMRR"),
    )
    by_name = segmented.groupBy("Segment").agg(*[F.avg(c).alias(c) for c in ("MRR", "Logins", "SatisfactionScore")])
    value = lambda name, column: F.max(F.when(F.col("Segment") == name, F.col(column)))
    least = F.min(F.when(F.col("Segment") != HIGH_VALUE, F.col("SatisfactionScore")))
    names = by_name.agg(
        (
            (value(HIGH_VALUE, "MRR") >= F.max("MRR"))
            & (value(SUPPORT, "SatisfactionScore") <= least)
            & (value(GROWING, "Logins") >= value(LOW, "Logins"))
        ).alias("NamesFollowMeans")
    )
    one = points.sparkSession.range(1)
    rows = [df.select(F.struct("*").alias("r")).scalar() for df in (whole, off, totals, names)]
    fields = [df.columns for df in (whole, off, totals, names)]
    return one.select(*[row[c].alias(c) for row, columns in zip(rows, fields) for c in columns])
