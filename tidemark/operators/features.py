"""Customer-level features.

Every child table becomes one row of facts per customer before it meets another table: a customer with
very many rows is folded on the map side, all joins share the key ``CustomerID`` on which the facts are
already partitioned, and no join meets a hot key. A plan computes only the facts it uses.

Where a function takes a child table it also takes that table's facts, so facts that several reports
need can be computed and staged once (:func:`staged_facts`).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import last_value, latest_rows, missing_last
from tidemark.sources.staging import staged

KEY = "CustomerID"
USAGE_METRICS = ["Logins", "ActiveUsers", "APICalls", "SessionMinutes"]


def sum_or_zero(column: str) -> Column:
    """Sum that skips missing values and is 0, not NULL, when all are missing."""
    return F.coalesce(F.sum(column), F.lit(0.0))


def subscription_facts(subscriptions: DataFrame) -> DataFrame:
    """Sums, last values and latest subscriptions per customer; facts are returned as they are."""
    if "TotalMRR" in subscriptions.columns:
        return subscriptions
    ends_last = F.struct("Status", "MRR", "Seats")
    wanted = {
        "TotalMRR": (sum_or_zero("MRR"), ["MRR"]),
        "PricedSubscriptions": (F.count("MRR"), ["MRR"]),
        "TotalSeats": (sum_or_zero("Seats"), ["Seats"]),
        "LastStart": (F.max("StartDate"), ["StartDate"]),
        "LastEnd": (F.max("EndDate"), ["EndDate"]),
        "LastPlan": (last_value("PlanName", "StartDate", "SubscriptionID"), ["PlanName", "StartDate"]),
        "LastStatus": (last_value("Status", "StartDate", "SubscriptionID"), ["Status", "StartDate"]),
        # Status of the subscription that started last, missing or not.
        "NewestStatus": (
            F.max_by("Status", missing_last("StartDate", "SubscriptionID")),
            ["Status", "StartDate"],
        ),
        # The subscription that ends last; an open one counts as the latest.
        "EndsLast": (
            F.max_by(ends_last, missing_last("EndDate", "SubscriptionID")),
            ["Status", "MRR", "Seats", "EndDate"],
        ),
    }
    present = set(subscriptions.columns)
    facts = [fact.alias(name) for name, (fact, needs) in wanted.items() if present.issuperset(needs)]
    return subscriptions.groupBy(KEY).agg(*facts)


def usage_facts(usage: DataFrame) -> DataFrame:
    """Mean of every usage metric per customer; facts are returned as they are."""
    if any(c.startswith("Mean") for c in usage.columns):
        return usage
    return usage.groupBy(KEY).agg(*[F.avg(c).alias(f"Mean{c}") for c in USAGE_METRICS if c in usage.columns])


def ticket_facts(tickets: DataFrame) -> DataFrame:
    """Number of tickets and means per customer; facts are returned as they are."""
    if "TicketCount" in tickets.columns:
        return tickets
    return tickets.groupBy(KEY).agg(
        F.count("TicketID").alias("TicketCount"),
        F.avg("SatisfactionScore").alias("MeanSatisfaction"),
        F.avg("ResolutionHours").alias("MeanResolutionHours"),
    )


def staged_facts(
    subscriptions: DataFrame, usage: DataFrame, tickets: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The facts of all three child tables, each table read once."""
    return (
        staged(subscription_facts(subscriptions), "subscription-facts"),
        staged(usage_facts(usage), "usage-facts"),
        staged(ticket_facts(tickets), "ticket-facts"),
    )


def revenue_by_customer(subscriptions: DataFrame) -> DataFrame:
    return subscription_facts(subscriptions).select(KEY, "TotalMRR")


def usage_means(usage: DataFrame, columns: list[str], prefix: str = "") -> DataFrame:
    return usage_facts(usage).select(KEY, *[F.col(f"Mean{c}").alias(f"{prefix}{c}") for c in columns])


def customer_360(
    customers: DataFrame,
    subscriptions: DataFrame,
    usage: DataFrame,
    tickets: DataFrame,
    as_of: date | None = None,
) -> DataFrame:
    """One row per customer; customers without subscriptions, usage or tickets are kept."""
    revenue = subscription_facts(subscriptions).select(
        KEY,
        "TotalMRR",
        F.col("TotalSeats").alias("Seats"),
        F.col("LastPlan").alias("Plan"),
        F.col("LastStatus").alias("Status"),
    )
    support = ticket_facts(tickets).select(
        KEY, F.col("TicketCount").alias("Tickets"), F.col("MeanSatisfaction").alias("Satisfaction")
    )
    today = F.lit(as_of) if as_of is not None else F.current_date()
    return (
        customers.join(revenue, KEY, "left")
        .join(usage_means(usage, ["Logins", "SessionMinutes"]), KEY, "left")
        .join(support, KEY, "left")
        .withColumn("TenureMonths", F.datediff(today, "SignupDate") / 30)
        .withColumn("RevenuePerSeat", F.try_divide("TotalMRR", "Seats"))
        .withColumn("TicketsPerMonth", F.try_divide("Tickets", "TenureMonths"))
    )


def customer_360_latest(
    customers: DataFrame, subscriptions: DataFrame, usage: DataFrame, tickets: DataFrame
) -> DataFrame:
    """Customers that have a subscription, usage and tickets, with the subscription that ends last."""
    latest = subscription_facts(subscriptions).select(
        KEY,
        F.col("EndsLast.Status").alias("Status"),
        F.col("EndsLast.MRR").alias("LatestMRR"),
        F.col("EndsLast.Seats").alias("LatestSeats"),
    )
    support = ticket_facts(tickets).select(
        KEY,
        F.col("MeanSatisfaction").alias("AverageSatisfaction"),
        F.col("MeanResolutionHours").alias("AverageResolutionHours"),
        "TicketCount",
    )
    activity = usage_means(usage, USAGE_METRICS, "Average")
    return customers.join(latest, KEY).join(activity, KEY).join(support, KEY)


def latest_subscription(subscriptions: DataFrame) -> DataFrame:
    """The subscription that started last, per customer."""
    return latest_rows(subscriptions, KEY, "StartDate", "SubscriptionID")


def analysis_date(customers: DataFrame, subscriptions: DataFrame) -> Column:
    """The greatest date in the signup, start and end columns, as a scalar subquery."""
    start, end = ("LastStart", "LastEnd") if "LastStart" in subscriptions.columns else ("StartDate", "EndDate")
    signup = customers.agg(F.max("SignupDate")).scalar()
    return F.greatest(signup, subscriptions.agg(F.greatest(F.max(start), F.max(end))).scalar())


def customer_summary(
    customers: DataFrame, subscriptions: DataFrame, as_of: date | None = None
) -> DataFrame:
    """Latest status, total revenue and tenure per customer, with the analysis date."""
    revenue = subscription_facts(subscriptions).select(KEY, "TotalMRR", F.col("NewestStatus").alias("Status"))
    base = customers.select(KEY, "CompanyName", "Industry", "SignupDate").join(revenue, KEY, "left")
    last_day = F.lit(as_of) if as_of is not None else analysis_date(customers, subscriptions)
    dated = base.withColumn("AnalysisDate", last_day)
    months = F.datediff("AnalysisDate", "SignupDate") / 30.44
    # greatest() skips NULL, so a missing signup date must be kept missing by hand.
    tenure = F.when(F.col("SignupDate").isNotNull(), F.round(F.greatest(months, F.lit(0.0)), 1))
    return dated.select(
        KEY,
        "CompanyName",
        "Industry",
        "SignupDate",
        "Status",
        F.coalesce("TotalMRR", F.lit(0.0)).alias("TotalMRR"),
        tenure.alias("TenureMonths"),
        "AnalysisDate",
    )


def segment_features(subscriptions: DataFrame, usage: DataFrame, tickets: DataFrame) -> DataFrame:
    """Features for segments; customers missing from the master are kept, missing numbers become 0."""
    revenue = subscription_facts(subscriptions).select(
        KEY, F.col("TotalMRR").alias("MRR"), F.col("TotalSeats").alias("Seats")
    )
    support = ticket_facts(tickets).select(KEY, F.col("MeanSatisfaction").alias("SatisfactionScore"))
    return (
        revenue.join(usage_means(usage, ["Logins", "ActiveUsers", "SessionMinutes"]), KEY)
        .join(support, KEY)
        .na.fill(0)
    )
