"""Churn trend, churn and engagement by status, sampling check and the churn hypothesis test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import month_start
from tidemark.functions.student_t import two_sided_p
from tidemark.operators.features import KEY, revenue_by_customer, subscription_facts, usage_means
from tidemark.sources.staging import staged

CHURNED = "Churned"


def churn_trend(subscriptions: DataFrame) -> DataFrame:
    """Churned subscriptions per month of their end date."""
    return (
        subscriptions.filter((F.col("Status") == CHURNED) & F.col("EndDate").isNotNull())
        .groupBy(month_start(F.col("EndDate")).alias("ChurnMonth"))
        .agg(F.count(F.lit(1)).alias("ChurnedSubscriptions"))
    )


def churn_rate_by_industry(customer_view: DataFrame) -> DataFrame:
    """Share of customers whose latest status is churned, highest first."""
    churned = F.when(F.col("Status") == CHURNED, 1).otherwise(0)
    return (
        customer_view.filter("Industry IS NOT NULL")
        .groupBy("Industry")
        .agg((F.avg(churned) * 100).alias("ChurnRate"))
        .orderBy(F.col("ChurnRate").desc_nulls_last())
    )


def mean_by_status(customer_view: DataFrame, column: str) -> DataFrame:
    """Mean of ``column`` by status; ``Customers`` counts those that have the value, over which the mean is taken."""
    return (
        customer_view.filter("Status IS NOT NULL")
        .groupBy("Status")
        .agg(F.avg(column).alias(column), F.count(column).alias("Customers"))
    )


def sample_check(subscriptions: DataFrame, size: int = 30, seeds: tuple[int, int] = (42, 43)) -> DataFrame:
    """Mean customer revenue of the population and of two disjoint random samples.

    A sample is the first ``size`` customers in the order of a seeded hash: repeatable, and found
    by a top-k per task instead of a sort of all customers.
    """
    revenue = staged(revenue_by_customer(subscriptions), "revenue")  # read three times

    def sample(rows: DataFrame, seed: int) -> DataFrame:
        order = F.md5(F.concat(F.col(KEY).cast("string"), F.lit(f"-{seed}")))
        return rows.orderBy(order, KEY).limit(size)

    first = sample(revenue, seeds[0])
    rest = revenue.join(F.broadcast(first.select(KEY)), KEY, "left_anti")  # ``size`` rows
    second = sample(rest, seeds[1])
    result = None
    for group, rows in (("Population", revenue), ("Sample 1", first), ("Sample 2", second)):
        part = rows.agg(F.avg("TotalMRR").alias("Mean")).select(F.lit(group).alias("Group"), "Mean")
        result = part if result is None else result.unionByName(part)
    return result


def welch_t_test(df: DataFrame, value: str, in_first_group: Column) -> DataFrame:
    """Two-sided t-test for unequal variances, as one row.

    One aggregate gives the count, mean and sample variance of both groups.
    """
    first = F.when(in_first_group, F.col(value).cast("double"))
    second = F.when(~in_first_group, F.col(value).cast("double"))
    one_row = df.agg(
        *[
            f(column).alias(f"{name}{group}")
            for group, column in ((1, first), (2, second))
            for name, f in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))
        ]
    )
    share1, share2 = F.try_divide("var1", "n1"), F.try_divide("var2", "n2")
    degrees = F.try_divide(
        F.pow(F.col("s1") + F.col("s2"), 2),
        F.try_divide(F.pow("s1", 2), F.col("n1") - 1) + F.try_divide(F.pow("s2", 2), F.col("n2") - 1),
    )
    enough = (F.col("n1") > 1) & (F.col("n2") > 1)
    statistic = F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(F.col("s1") + F.col("s2")))
    row = (
        one_row.select("*", share1.alias("s1"), share2.alias("s2"))
        .select(F.when(enough, statistic).alias("t"), F.when(enough, degrees).alias("degrees"))
        .first()
    )
    result = [(row["t"], row["degrees"], two_sided_p(row["t"], row["degrees"]))]
    return df.sparkSession.createDataFrame(
        result, "TStatistic double, DegreesOfFreedom double, PValue double"
    )


def churn_welch_t_test(subscriptions: DataFrame, usage: DataFrame) -> DataFrame:
    """Mean logins of churned against retained customers, by latest status.

    A customer without a status counts as retained.
    """
    status = subscription_facts(subscriptions).select(KEY, F.col("NewestStatus").alias("Status"))
    data = status.join(usage_means(usage, ["Logins"]), KEY)
    return welch_t_test(data, "Logins", F.col("Status").eqNullSafe(F.lit(CHURNED)))
