"""Revenue summaries, pivots, key figures and dashboard slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.features import KEY, subscription_facts
from tidemark.operators.summaries import stack_rows
from tidemark.sources.staging import staged

#: Columns that a wide table may have at most; more is an error, never a cut.
MAX_PLANS = 1000


def industry_summary(customer_view: DataFrame) -> DataFrame:
    return (
        customer_view.filter("Industry IS NOT NULL")
        .groupBy("Industry")
        .agg(F.count(KEY).alias("Customers"), F.coalesce(F.sum("TotalMRR"), F.lit(0.0)).alias("Revenue"))
    )


def industry_plan_revenue(customer_view: DataFrame) -> DataFrame:
    """Revenue by industry and latest plan, a row for each pair that occurs."""
    present = customer_view.filter("Industry IS NOT NULL AND Plan IS NOT NULL")
    return present.groupBy("Industry", "Plan").agg(F.coalesce(F.sum("TotalMRR"), F.lit(0.0)).alias("Revenue"))


def pivot_industry_plan(customer_view: DataFrame, plans: list[str] | None = None) -> DataFrame:
    """Wide form of ``industry_plan_revenue``, 0 where there is nothing; a column for each plan.

    A plan that occurs and is not in ``plans`` is an error. Plans are looked up in the long table if not given.
    """
    long = staged(industry_plan_revenue(customer_view), "industry-plan")
    present = sorted(r["Plan"] for r in long.select("Plan").distinct().limit(MAX_PLANS + 1).collect())
    if len(present) > MAX_PLANS:
        raise ValueError(f"more than {MAX_PLANS} plans: use industry_plan_revenue")
    if plans is not None and set(present) - set(plans):
        raise ValueError(f"plans without a column: {sorted(set(present) - set(plans))}")
    columns = plans if plans is not None else present
    return long.groupBy("Industry").pivot("Plan", columns).agg(F.sum("Revenue")).na.fill(0)


def revenue_by_plan(subscriptions: DataFrame) -> DataFrame:
    return (
        subscriptions.filter("PlanName IS NOT NULL")
        .groupBy("PlanName")
        .agg(
            F.count("MRR").alias("SubscriptionCount"),
            F.coalesce(F.sum("MRR"), F.lit(0.0)).alias("TotalMRR"),
            F.avg("MRR").alias("AverageMRR"),
        )
    )


def revenue_by_customer_dimension(
    customers: DataFrame, subscriptions: DataFrame, dimension: str
) -> DataFrame:
    """Count, sum and mean of MRR by a customer column; subscriptions without it are left out.

    Subscriptions are summed per customer first: the join then has one row per customer.
    """
    per_customer = subscription_facts(subscriptions).select(KEY, "PricedSubscriptions", "TotalMRR")
    count, total = F.sum("PricedSubscriptions"), F.sum("TotalMRR")
    return (
        per_customer.join(customers.select(KEY, dimension), KEY)
        .filter(F.col(dimension).isNotNull())
        .groupBy(dimension)
        .agg(
            count.alias("SubscriptionCount"),
            total.alias("TotalMRR"),
            F.try_divide(total, count).alias("AverageMRR"),
        )
    )


def share_of_rows(df: DataFrame, column: str, count_name: str) -> DataFrame:
    """Rows per value and their share of all rows in percent."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias(count_name))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.select(column, count_name, (F.col(count_name) / total * 100).alias("Share"))


def kpi_table(summary: DataFrame) -> DataFrame:
    """Key figures over the customer summary: a number or, for the analysis date, a date."""
    one_row = summary.agg(
        F.sum("TotalMRR").alias("total"),
        (F.count(F.when(F.col("Status") == "Churned", 1))).alias("churned"),
        F.count(KEY).alias("customers"),
        F.avg("TotalMRR").alias("mean"),
        F.avg("TenureMonths").alias("tenure"),
        F.max("AnalysisDate").alias("date"),
    )
    no_date, no_number = F.lit(None).cast("date"), F.lit(None).cast("double")
    rows = [
        ("Total Customers", F.col("customers").cast("double"), no_date),
        ("Churned Customers", F.col("churned").cast("double"), no_date),
        ("Total MRR", F.col("total"), no_date),
        ("Churn Rate", F.try_divide("churned", "customers"), no_date),
        ("Average Revenue per Account", F.col("mean"), no_date),
        ("Average Tenure", F.col("tenure"), no_date),
        ("Analysis Date", no_number, F.col("date")),
    ]
    return stack_rows(
        one_row, [{"KPI": F.lit(name), "Value": v, "DateValue": d} for name, v, d in rows]
    )


def kpi_slices(customers: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Measures for every combination of the four dashboard filters (industry, country, plan, status).

    A customer has one industry and country, so distinct customers need care for plan and status only.
    The first step builds the plan and status subtotals of each customer, one row per customer and
    subtotal; in the second step customers simply add up, and the industry and country subtotals fold
    in the same task. Rows that carry a customer id are expanded four times instead of sixteen.
    """
    place, terms = ["Industry", "Country"], ["PlanName", "Status"]
    levels = ["_plan_all", "_status_all"]

    def subsets(pair: list[str]) -> list[list[str]]:
        return [pair, pair[:1], pair[1:], []]

    per_customer = subscriptions.groupBy(KEY, *terms).agg(
        F.count(F.lit(1)).alias("n"), F.sum("MRR").alias("revenue")
    )
    # One row per customer even if the master repeats an id.
    homes = customers.groupBy(KEY).agg(F.min(F.struct(*place)).alias("home")).select(KEY, "home.*")
    subtotals = (
        per_customer.join(homes, KEY)
        .groupingSets([[KEY, *place, *s] for s in subsets(terms)], KEY, *place, *terms)
        .agg(
            *[F.grouping(c).cast("int").alias(level) for c, level in zip(terms, levels)],
            F.sum("n").alias("n"),
            F.sum("revenue").alias("revenue"),
        )
    )
    level = F.grouping("Industry") * 8 + F.grouping("Country") * 4 + F.col("_plan_all") * 2 + F.col("_status_all")
    return (
        subtotals.groupingSets([[*terms, *levels, *s] for s in subsets(place)], *terms, *levels, *place)
        .agg(
            level.cast("int").alias("SliceLevel"),
            F.count(F.lit(1)).alias("Customers"),
            F.sum("n").alias("Subscriptions"),
            F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("TotalMRR"),
        )
        .select(*place, *terms, "SliceLevel", "Customers", "Subscriptions", "TotalMRR")
    )
