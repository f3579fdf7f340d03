"""High-value and at-risk flags, quartile-rule risk scores, levels and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.features import KEY, revenue_by_customer, ticket_facts, usage_means
from tidemark.operators.quantiles import exact_quantiles
from tidemark.sources.staging import staged

# Points per rule, and the lowest score of each level, highest first.
POINTS = 20
LEVELS = (("Critical", 80), ("High", 60), ("Medium", 40), ("Low", 20))
LOWEST_LEVEL = "Minimal"


def _holds(condition: Column) -> Column:
    """A comparison with a missing value does not hold."""
    return F.coalesce(condition, F.lit(False))


def _limit(value: float | None) -> Column:
    return F.lit(value).cast("double")


def _yes_no(condition: Column) -> Column:
    return F.when(condition, "Yes").otherwise("No")


def customer_flags(subscriptions: DataFrame, usage: DataFrame, null_policy: str = "skip") -> DataFrame:
    """HighValue (revenue at or above the third quartile), AtRisk (active users and session minutes
    both at or below their first quartile) and a score of 1 to 3.

    ``null_policy='skip'`` leaves missing values out of the quartiles. ``'propagate'`` makes the
    quartile of a column with any missing value unknown, so no comparison with it holds.
    """
    if null_policy not in ("skip", "propagate"):
        raise ValueError(f"unknown null_policy: {null_policy}")
    columns = ["TotalMRR", "ActiveUsers", "SessionMinutes"]
    base = staged(
        revenue_by_customer(subscriptions).join(
            usage_means(usage, ["ActiveUsers", "SessionMinutes"]), KEY, "left"
        ),
        "flags",
    )
    quartiles = exact_quantiles(base, {"TotalMRR": [0.75], "ActiveUsers": [0.25], "SessionMinutes": [0.25]})
    limits = {c: quartiles[c][0] for c in columns}
    if null_policy == "propagate":
        missing = base.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns]).first()
        limits = {c: None if missing[c] else v for c, v in limits.items()}
    high_value = _holds(F.col("TotalMRR") >= _limit(limits["TotalMRR"]))
    at_risk = _holds(F.col("ActiveUsers") <= _limit(limits["ActiveUsers"])) & _holds(
        F.col("SessionMinutes") <= _limit(limits["SessionMinutes"])
    )
    return base.select(
        KEY,
        *columns,
        _yes_no(high_value).alias("HighValue"),
        _yes_no(at_risk).alias("AtRisk"),
        F.when(high_value & at_risk, 3).when(at_risk, 2).otherwise(1).alias("RiskScore"),
    )


def risk_features(
    customers: DataFrame, subscriptions: DataFrame, usage: DataFrame, tickets: DataFrame
) -> DataFrame:
    """Customers that have subscriptions, usage and tickets."""
    support = ticket_facts(tickets).select(KEY, "TicketCount", F.col("MeanSatisfaction").alias("Satisfaction"))
    return (
        customers.select(KEY, "CompanyName")
        .join(revenue_by_customer(subscriptions), KEY)
        .join(usage_means(usage, ["Logins", "ActiveUsers", "SessionMinutes"]), KEY)
        .join(support, KEY)
    )


def risk_level(score: Column) -> Column:
    level = None
    for name, lowest in LEVELS:
        reached = score >= lowest
        level = F.when(reached, name) if level is None else level.when(reached, name)
    return level.otherwise(LOWEST_LEVEL)


def risk_scores(
    customers: DataFrame, subscriptions: DataFrame, usage: DataFrame, tickets: DataFrame
) -> DataFrame:
    """Five quartile rules of equal weight over the joined customers, and the level of their sum."""
    base = staged(risk_features(customers, subscriptions, usage, tickets), "risk")
    low_is_bad = ["Logins", "ActiveUsers", "SessionMinutes", "Satisfaction"]
    quartiles = exact_quantiles(base, {c: [0.25] for c in low_is_bad} | {"TicketCount": [0.75]})
    rules = [F.col(c) <= _limit(quartiles[c][0]) for c in low_is_bad]
    rules.append(F.col("TicketCount") >= _limit(quartiles["TicketCount"][0]))
    score = F.lit(0)
    for rule in rules:
        score = score + _holds(rule).cast("int") * POINTS
    return base.withColumn("RiskScore", score).withColumn("RiskLevel", risk_level(F.col("RiskScore")))


def risk_summary(scores: DataFrame) -> DataFrame:
    return scores.groupBy("RiskLevel").agg(
        F.count(KEY).alias("Customers"), F.coalesce(F.sum("TotalMRR"), F.lit(0.0)).alias("TotalMRR")
    )


def top_risk(scores: DataFrame, k: int = 10) -> DataFrame:
    """The k highest scores; equal scores by customer id."""
    return scores.orderBy(F.col("RiskScore").desc(), KEY).limit(k)
