"""The full set of reports over the four cleaned tables, one written table per report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import features, summaries, temporal
from tidemark.plans import churn, cohorts, revenue, risk, segments, sql_queries
from tidemark.sources.readers import try_parse_date, try_parse_number
from tidemark.sources.sinks import write_reports
from tidemark.sources.staging import released, staged

Tables = dict[str, DataFrame]

VIEW_METRICS = [
    "LatestMRR", "LatestSeats", "AverageLogins", "AverageActiveUsers", "AverageAPICalls",
    "AverageSessionMinutes", "TicketCount", "AverageSatisfaction", "AverageResolutionHours",
]
SQL_REPORTS = {
    "customer_revenue": sql_queries.customer_revenue,
    "plan_revenue": sql_queries.plan_revenue,
    "industry_having": sql_queries.industry_having,
    "value_category": sql_queries.value_category,
    "above_average": sql_queries.above_average,
    "usage_summary": sql_queries.usage_summary,
    "revenue_rank": sql_queries.revenue_rank,
}


def lenient(df: DataFrame) -> DataFrame:
    """Prices to numbers (0 where there is none) and dates to dates (missing where there is none)."""
    dates = {c: try_parse_date(c) for c in ("SignupDate", "StartDate", "EndDate") if c in df.columns}
    prices = {c: try_parse_number(c) for c in ("MRR",) if c in df.columns}
    return df.withColumns(dates | prices)


def write_workbook(spark: SparkSession, tables: Tables, folder: str) -> dict[str, str]:
    """The four tables, the customer summary, three revenue summaries and the key figures.

    Each step reads what the step before has written. Here, prices that are missing or no numbers count as 0, and dates
    that are no dates as missing.
    """
    paths = write_reports(tables, folder)
    customers, subscriptions = (spark.read.parquet(paths[name]) for name in ("customers", "subscriptions"))
    customers, subscriptions = lenient(customers), lenient(subscriptions)
    used = [features.KEY, "TotalMRR", "PricedSubscriptions", "NewestStatus", "LastStart", "LastEnd"]
    facts = staged(features.subscription_facts(subscriptions).select(used), "facts")
    paths |= write_reports({"customer_summary": features.customer_summary(customers, facts)}, folder)
    by_dimension = revenue.revenue_by_customer_dimension
    return paths | write_reports(
        {
            "revenue_by_plan": revenue.revenue_by_plan(subscriptions),
            "revenue_by_industry": by_dimension(customers, facts, "Industry"),
            "revenue_by_channel": by_dimension(customers, facts, "AcquisitionChannel"),
            "kpi": revenue.kpi_table(spark.read.parquet(paths["customer_summary"])),
        },
        folder,
    )


def analysis_reports(tables: Tables, as_of: date | None = None) -> Tables:
    """Every analysis by name. Facts and views that several reports read are staged once.

    ``tables`` are read several times: pass stored or staged tables.
    """
    customers, subscriptions, usage = tables["customers"], tables["subscriptions"], tables["usage"]
    facts = features.staged_facts(subscriptions, usage, tables["tickets"])
    view = staged(features.customer_360(customers, *facts, as_of), "view")
    latest = staged(features.customer_360_latest(customers, *facts), "latest")
    retention = staged(cohorts.cohort_retention(customers, usage), "retention")
    scores = staged(risk.risk_scores(customers, *facts), "scores")
    points = segments.vectors(features.segment_features(*facts))
    fits = segments.best_fits(points, list(range(2, 7)))
    segmented = staged(segments.segments_of(points, fits[4]), "segments")
    metrics = [
        (subscriptions, ["MRR", "Seats"]),
        (usage, ["Logins", "ActiveUsers", "APICalls", "SessionMinutes"]),
    ]
    return {
        "metric_statistics": summaries.metric_stats(metrics),
        "metric_description": summaries.describe(metrics),
        "customer_flags": risk.customer_flags(*facts[:2]),
        "customer_view": summaries.iqr_outliers(view, "TotalMRR"),
        "industry_summary": revenue.industry_summary(view),
        "industry_plan_revenue": revenue.industry_plan_revenue(view),
        "industry_plan_pivot": revenue.pivot_industry_plan(view),
        "correlation": summaries.correlation_matrix(view, ["TotalMRR", "Seats", "Logins", "SessionMinutes"]),
        "sample_comparison": churn.sample_check(facts[0]),
        "churn_hypothesis": churn.churn_welch_t_test(*facts[:2]),
        "cohort_retention": retention,
        "retention_matrix": cohorts.retention_matrix(retention),
        "retention_curve": cohorts.retention_curve(customers, usage),
        "cohort_best_worst": cohorts.best_and_worst_cohort(retention),
        "churn_trend": churn.churn_trend(subscriptions),
        "churn_by_industry": churn.churn_rate_by_industry(latest),
        "active_by_day": temporal.active_by_day(subscriptions, "StartDate", "EndDate", "MRR"),
        "plan_at_usage": temporal.as_of_join(
            usage, subscriptions, "CustomerID", "Month", "StartDate", "SubscriptionID", ["SubscriptionID", "PlanName", "Status"]
        ),
        "session_histogram": summaries.histogram(usage, "SessionMinutes"),
        "logins_by_status": churn.mean_by_status(latest, "AverageLogins"),
        "satisfaction_by_status": churn.mean_by_status(latest, "AverageSatisfaction"),
        "customer_segments": segmented,
        "segment_summary": segments.segment_summary(segmented),
        "risk_scores": scores,
        "risk_summary": risk.risk_summary(scores),
        "risk_top10": risk.top_risk(scores),
        "channel_distribution": revenue.share_of_rows(customers, "AcquisitionChannel", "Customers"),
        "kpi_slices": revenue.kpi_slices(customers, subscriptions),
        "elbow_cost": segments.elbow_cost(points, fits=fits),
        "metric_correlation": summaries.correlation_long(latest, VIEW_METRICS),
        "ticket_priority_distribution": revenue.share_of_rows(tables["tickets"], "Priority", "Tickets"),
        "sql_orphans": sql_queries.orphans(tables),
    } | {f"sql_{name}": report(subscriptions.sparkSession, tables) for name, report in SQL_REPORTS.items()}


def write_all(
    spark: SparkSession, tables: Tables, folder: str, as_of: date | None = None, fmt: str = "parquet"
) -> dict[str, str]:
    """Write the cleaned tables and every report; returns name → path. ``fmt`` is that of the reports."""
    with released(spark):
        paths = write_workbook(spark, tables, f"{folder}/tables")
        stored = {name: spark.read.parquet(paths[name]) for name in tables}
        return paths | write_reports(analysis_reports(stored, as_of), f"{folder}/reports", fmt)
