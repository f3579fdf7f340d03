"""Signup cohorts and monthly retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import month_start, whole_months_between
from tidemark.operators.features import KEY
from tidemark.operators.sketches import distinct_sketches, estimate, merged
from tidemark.operators.summaries import stack_rows


def cohorts(customers: DataFrame) -> DataFrame:
    """Distinct (customer, signup month)."""
    return customers.select(KEY, month_start(F.col("SignupDate")).alias("Cohort")).distinct()


def monthly_activity(customers: DataFrame, activity: DataFrame) -> DataFrame:
    """Distinct (customer, cohort, months since signup), from signup on.

    Activity shrinks to one row per customer and month before it meets the cohorts, so a customer
    with very many rows is small by then. Customers without a cohort drop out.
    """
    months = activity.select(KEY, month_start(F.col("Month")).alias("ActivityMonth")).distinct()
    month_no = whole_months_between(F.col("ActivityMonth"), F.col("Cohort"))
    return (
        months.join(cohorts(customers), KEY)
        .select(KEY, "Cohort", month_no.alias("MonthNo"))
        .filter("MonthNo >= 0")
    )


def cohort_retention(customers: DataFrame, activity: DataFrame) -> DataFrame:
    """Active customers, cohort size and retention rate per cohort and month number."""
    active = (
        monthly_activity(customers, activity)
        .groupBy("Cohort", "MonthNo")
        .agg(F.count(F.lit(1)).alias("ActiveCustomers"))  # rows are distinct already
    )
    sizes = (
        cohorts(customers)
        .filter("Cohort IS NOT NULL")
        .groupBy("Cohort")
        .agg(F.count(KEY).alias("CohortSize"))
    )
    rate = F.round(F.col("ActiveCustomers") / F.col("CohortSize") * 100, 2)
    return active.join(sizes, "Cohort").withColumn("RetentionRate", rate)


def retention_matrix(retention: DataFrame, at_least: int = 0, at_most: int = 1200) -> DataFrame:
    """One row per cohort, one column per month number.

    Columns run from 0 to the last month found, and to ``at_least`` columns for a stable schema. A month number from
    ``at_most`` on (a mistyped year, say) is an error that names it; the table of ``cohort_retention`` has no such bound.
    ``retention`` is read twice: pass a staged table.
    """
    last = retention.agg(F.max("MonthNo").alias("m")).first()["m"]
    if last is not None and last >= at_most:
        raise ValueError(f"month number {last} would give a matrix of {last + 1} columns, of {at_most} allowed")
    months = list(range(max(at_least, 0 if last is None else last + 1)))
    return retention.groupBy("Cohort").pivot("MonthNo", months).agg(F.first("RetentionRate"))


def retention_curve(customers: DataFrame, activity: DataFrame) -> DataFrame:
    """Active share of all customers per month number, in order."""
    total = customers.agg(F.count_distinct(KEY)).scalar()
    return (
        monthly_activity(customers, activity)
        .groupBy("MonthNo")
        .agg(F.count_distinct(KEY).alias("ActiveCustomers"))
        .select(
            "MonthNo",
            "ActiveCustomers",
            F.round(F.col("ActiveCustomers") / total * 100, 2).alias("RetentionRate"),
        )
        .orderBy("MonthNo")
    )


def activity_sketches(customers: DataFrame, activity: DataFrame) -> DataFrame:
    """Sketches of the active customers per cohort and month number, to be stored and merged."""
    return distinct_sketches(monthly_activity(customers, activity), ["Cohort", "MonthNo"], KEY)


def approximate_curve(sketches: DataFrame) -> DataFrame:
    """Active customers per month number over all cohorts, estimated from stored sketches alone."""
    return merged(sketches, ["MonthNo"]).select("MonthNo", estimate().alias("ActiveCustomers"))


def best_and_worst_cohort(retention: DataFrame, month_no: int = 1) -> DataFrame:
    """The cohorts with the highest and lowest rate in a month; the earliest one on equal rates."""
    cohort = F.date_format("Cohort", "yyyy-MM")
    chosen = F.struct(cohort.alias("Cohort"), "RetentionRate")
    days = F.unix_date("Cohort")
    one_row = retention.filter(F.col("MonthNo") == month_no).agg(
        F.max_by(chosen, F.struct(F.col("RetentionRate"), -days)).alias("best"),
        F.min_by(chosen, F.struct(F.col("RetentionRate"), days)).alias("worst"),
    )
    return stack_rows(
        one_row,
        [
            {
                "Category": F.lit(label),
                "Cohort": F.col(f"{column}.Cohort"),
                "RetentionRate": F.col(f"{column}.RetentionRate"),
            }
            for label, column in (("Best Cohort", "best"), ("Worst Cohort", "worst"))
        ],
    )
