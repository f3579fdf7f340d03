"""Statistics tables over numeric columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.gram import correlations
from tidemark.operators.quantiles import exact_quantiles


def stack_rows(one_row: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into labelled rows."""
    structs = [F.struct(*[c.alias(name) for name, c in row.items()]) for row in rows]
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def metric_stats(metrics: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Mean, population deviation, minimum and maximum per metric; one aggregate per table."""
    parts = []
    for df, columns in metrics:
        one_row = df.agg(
            *[
                f(c).alias(f"{name}_{c}")
                for c in columns
                for name, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))
            ]
        )
        parts.append(
            stack_rows(
                one_row,
                [
                    {
                        "Metric": F.lit(c),
                        "Mean": F.round(f"mean_{c}", 2),
                        "Std": F.round(f"std_{c}", 2),
                        "Min": F.col(f"min_{c}").cast("double"),
                        "Max": F.col(f"max_{c}").cast("double"),
                    }
                    for c in columns
                ],
            )
        )
    return _union(parts)


def describe(metrics: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per metric.

    The tables may differ in length. Pass stored or staged tables: the quartiles need more passes.
    """
    parts = []
    for df, columns in metrics:
        quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
        one_row = df.agg(
            *[
                f(c).alias(f"{name}_{c}")
                for c in columns
                for name, f in (
                    ("n", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max),
                )
            ]
        )
        parts.append(
            stack_rows(
                one_row,
                [
                    {
                        "Metric": F.lit(c),
                        "count": F.col(f"n_{c}"),
                        "mean": F.col(f"mean_{c}"),
                        "std": F.col(f"std_{c}"),
                        "min": F.col(f"min_{c}").cast("double"),
                        "q25": F.lit(quartiles[c][0]).cast("double"),
                        "q50": F.lit(quartiles[c][1]).cast("double"),
                        "q75": F.lit(quartiles[c][2]).cast("double"),
                        "max": F.col(f"max_{c}").cast("double"),
                    }
                    for c in columns
                ],
            )
        )
    return _union(parts)


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlations, one row and one column per metric; rows with either value missing left out.

    The rows are read once, and none is repeated; a metric that does not vary has no correlations.
    """
    pairs = correlations(df, columns)
    metric = F.get(F.array(*[F.lit(c) for c in columns]), F.col("a"))
    return pairs.groupBy(metric.alias("Metric")).agg(
        *[F.max(F.when(F.col("b") == i, F.col("r"))).alias(c) for i, c in enumerate(columns)]
    )


def correlation_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """The correlation matrix with one row per ordered pair."""
    return (
        correlation_matrix(df, columns)
        .withColumnRenamed("Metric", "MetricA")
        .unpivot("MetricA", columns, "MetricB", "Correlation")
    )


def histogram(df: DataFrame, column: str, bins: int = 25) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins are kept."""
    values = df.select(F.col(column).cast("double").alias("x")).filter("x IS NOT NULL")
    # A single value gets a range of one around it.
    widen = F.when(F.min("x") == F.max("x"), 0.5).otherwise(0.0)
    bounds = values.agg(F.struct((F.min("x") - widen).alias("lo"), (F.max("x") + widen).alias("hi"))).scalar()
    low, high = bounds["lo"], bounds["hi"]
    # A computed value may differ in its last bit from the pass that found the bounds: keep it inside.
    place = F.floor((F.col("x") - low) / (high - low) * bins)
    inside = F.least(F.greatest(place, F.lit(0)), F.lit(bins - 1))
    counts = values.groupBy(inside.cast("int").alias("Bin")).agg(
        F.count(F.lit(1)).alias("Records")
    )
    every_bin = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("Bin"))
    width = (high - low) / bins
    end = F.when(F.col("Bin") == bins - 1, high).otherwise(low + (F.col("Bin") + 1) * width)
    return every_bin.join(F.broadcast(counts), "Bin", "left").select(  # at most one row per bin
        "Bin",
        (low + F.col("Bin") * width).alias("BinStart"),
        end.alias("BinEnd"),
        F.coalesce("Records", F.lit(0)).cast("long").alias("Records"),
    )


def min_max_scaled(df: DataFrame, column: str, output: str, decimals: int = 3) -> DataFrame:
    """(x − min) / (max − min); NULL for a constant column."""
    bounds = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    scaled = F.try_divide(F.col(column) - bounds["lo"], bounds["hi"] - bounds["lo"])
    return df.withColumn(output, F.round(scaled, decimals))


def standardised(df: DataFrame, columns: list[str], suffix: str = "Scaled") -> DataFrame:
    """(x − mean) / population deviation per column; a constant column becomes 0."""
    stats = df.agg(
        F.struct(*[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("mean", F.avg), ("sd", F.stddev_pop))])
    ).scalar()

    def scaled(c: str) -> Column:
        deviation = F.when(stats[f"sd_{c}"] == 0, 1.0).otherwise(stats[f"sd_{c}"])
        return ((F.col(c) - stats[f"mean_{c}"]) / deviation).alias(f"{c}{suffix}")

    return df.select("*", *[scaled(c) for c in columns])


def iqr_outliers(df: DataFrame, column: str, output: str = "Outlier", factor: float = 1.5) -> DataFrame:
    """Flag values outside q1 − 1.5·IQR … q3 + 1.5·IQR; a missing value is no outlier.

    Pass a stored or staged table.
    """
    q1, q3 = exact_quantiles(df, {column: [0.25, 0.75]})[column]
    if q1 is None:
        return df.withColumn(output, F.lit(False))
    spread = factor * (q3 - q1)
    outside = (F.col(column) < q1 - spread) | (F.col(column) > q3 + spread)
    return df.withColumn(output, F.coalesce(outside, F.lit(False)))
