"""Our results against published result tables, when a folder with them is given.

``PUBLISHED_RESULTS`` names a folder that holds the raw tables, the cleaned tables and result tables
as CSV in any layout. Tables are recognised by their header, read as data, and never changed.
"""

import csv
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cleaning, features, summaries
from tidemark.plans import cohorts, revenue, risk, segments, sql_queries
from tidemark.schemas import BUSINESS
from tidemark.sources import readers

FOLDER = os.environ.get("PUBLISHED_RESULTS", "")
pytestmark = pytest.mark.skipif(not FOLDER, reason="PUBLISHED_RESULTS is not set")

CUSTOMERS = ",".join(BUSINESS["customers"].names)
SUBSCRIPTIONS = ",".join(BUSINESS["subscriptions"].names)


def _found(header: str) -> list[Path]:
    """Files with this header, longest first."""
    files = []
    for path in Path(FOLDER).rglob("*.csv"):
        with open(path, newline="") as file:
            lines = file.read().splitlines()
        if lines and lines[0] == header:
            files.append((len(lines), path))
    if not files:
        pytest.skip(f"no table with header {header}")
    return [path for _, path in sorted(files, reverse=True)]


def _published(header: str, pick: int = 0) -> list[dict]:
    with open(_found(header)[pick], newline="") as file:
        return list(csv.DictReader(file))


def _same(df, published: list[dict], *keys: str, columns=None):
    """Compare row by row on the columns that both have; numbers to nine digits."""
    ours = {tuple(str(r[k]) for k in keys): r for r in df.collect()}
    assert len(ours) == len(published)
    columns = columns or [c for c in published[0] if c in df.columns]
    assert columns
    for row in published:
        mine = ours[tuple(row[k] for k in keys)]
        for c in columns:
            if row[c] == "":
                assert mine[c] is None, (c, row)
            elif isinstance(mine[c], (int, float)):
                assert mine[c] == pytest.approx(float(row[c]), rel=1e-9), (c, row)
            else:
                assert str(mine[c]) == row[c], (c, row)


@pytest.fixture(scope="module")
def cleaned(spark):
    raw = readers.load_tables(
        spark,
        {"customers": str(_found(CUSTOMERS)[0]), "subscriptions": str(_found(SUBSCRIPTIONS)[0])},
    )
    customers = cleaning.clean_customers(raw["customers"])
    subscriptions = cleaning.clean_subscriptions(raw["subscriptions"], customers)
    empty = {name: spark.createDataFrame([], BUSINESS[name]) for name in ("usage", "tickets")}
    return {"customers": customers, "subscriptions": subscriptions} | empty


def test_cleaned_tables(cleaned):
    _same(cleaned["customers"], _published(CUSTOMERS, -1), "CustomerID")
    _same(cleaned["subscriptions"], _published(SUBSCRIPTIONS + ",CustomerMatchStatus"), "SubscriptionID")


@pytest.mark.parametrize(
    "report, header, key",
    [
        (sql_queries.customer_revenue, "CustomerID,CompanyName,Industry,TotalMRR", "CustomerID"),
        (sql_queries.plan_revenue, "PlanName,SubscriptionCount,TotalMRR,AverageMRR", "PlanName"),
        (sql_queries.industry_having, "Industry,Customers,TotalMRR", "Industry"),
        (sql_queries.value_category, "CustomerID,CompanyName,TotalMRR,CustomerValue", "CustomerID"),
        (sql_queries.above_average, "CustomerID,CompanyName,TotalMRR", "CustomerID"),
        (sql_queries.revenue_rank, "CustomerID,CompanyName,TotalMRR,RevenueRank", "CustomerID"),
    ],
)
def test_sql_reports(spark, cleaned, report, header, key):
    _same(report(spark, cleaned), _published(header), key)


def test_rank_over_range_partitions(spark, cleaned):
    ranked = sql_queries.revenue_rank(spark, cleaned, partitions=7)
    _same(ranked, _published("CustomerID,CompanyName,TotalMRR,RevenueRank"), "CustomerID")


def test_orphans(cleaned):
    _same(sql_queries.orphans(cleaned), _published("SubscriptionID,CustomerID,PlanName,MRR"), "SubscriptionID")


def test_metric_tables(cleaned):
    tables = [(cleaned["subscriptions"], ["MRR", "Seats"])]
    published = [r for r in _published("Metric,Mean,Std,Min,Max") if r["Metric"] in ("MRR", "Seats")]
    _same(summaries.metric_stats(tables), published, "Metric")
    described = summaries.describe(tables).toDF("Metric", "count", "mean", "std", "min", "25%", "50%", "75%", "max")
    published = [dict(r, Metric=r.pop("")) for r in _published(",count,mean,std,min,25%,50%,75%,max")]
    _same(described, [r for r in published if r["Metric"] in ("MRR", "Seats")], "Metric")


def test_flags_with_missing_usage(spark, cleaned):
    """Published usage means come back when each is the only usage row of its customer."""
    published = _published("CustomerID,TotalMRR,ActiveUsers,SessionMinutes,HighValue,AtRisk,RiskScore")
    means = [
        (r["CustomerID"], float(r["ActiveUsers"]), float(r["SessionMinutes"])) for r in published if r["ActiveUsers"]
    ]
    usage = spark.createDataFrame(means, "CustomerID string, ActiveUsers double, SessionMinutes double")
    _same(risk.customer_flags(cleaned["subscriptions"], usage, null_policy="propagate"), published, "CustomerID")


def test_customer_view_reports(cleaned):
    view = features.customer_360(**cleaned)
    _same(revenue.industry_summary(view), _published("Industry,Customers,Revenue"), "Industry")
    _same(revenue.pivot_industry_plan(view), _published("Industry,Business,Enterprise,Growth,Starter"), "Industry")
    published = _published(",TotalMRR,Seats,Logins,SessionMinutes")
    matrix = {r["Metric"]: r for r in summaries.correlation_matrix(view, ["TotalMRR", "Seats"]).collect()}
    expected = next(r for r in published if r[""] == "TotalMRR")
    assert matrix["TotalMRR"]["Seats"] == pytest.approx(float(expected["Seats"]))


def test_cohort_tables(spark, cleaned):
    published = _published("Cohort,MonthNo,ActiveCustomers,CohortSize,RetentionRate")
    sizes = {
        r["Cohort"]: r["n"]
        for r in cohorts.cohorts(cleaned["customers"])
        .groupBy(F.date_format("Cohort", "yyyy-MM").alias("Cohort"))
        .agg(F.count("*").alias("n"))
        .collect()
    }
    assert all(sizes[r["Cohort"]] == int(r["CohortSize"]) for r in published)
    retention = spark.createDataFrame(
        [(r["Cohort"], int(r["MonthNo"]), float(r["RetentionRate"])) for r in published],
        "Cohort string, MonthNo int, RetentionRate double",
    ).withColumn("Cohort", F.to_date(F.concat("Cohort", F.lit("-01"))))
    matrix = cohorts.retention_matrix(retention).withColumn("Cohort", F.date_format("Cohort", "yyyy-MM"))
    months = len(matrix.columns) - 1
    _same(matrix, _published(",".join(["Cohort", *map(str, range(months))])), "Cohort")
    _same(cohorts.best_and_worst_cohort(retention), _published("Category,Cohort,RetentionRate"), "Category")


def test_key_figures(cleaned):
    summary = features.customer_summary(cleaned["customers"], cleaned["subscriptions"])
    kpis = {r["KPI"]: r["Value"] for r in revenue.kpi_table(summary).collect()}
    assert (kpis["Total Customers"], kpis["Churned Customers"]) == (420, 109)
    assert kpis["Total MRR"] == pytest.approx(263365.56)


def test_segments_are_as_tight_as_the_published_ones(spark):
    header = ",".join(["CustomerID", *segments.FEATURES, "Cluster", "Segment"])
    published = _published(header)
    rows = [(r["CustomerID"], *[float(r[c]) for c in segments.FEATURES], r["Segment"]) for r in published]
    table = spark.createDataFrame(rows, ["CustomerID", *segments.FEATURES, "Segment"])
    _same(segments.segment_summary(table), _published("Segment,Customers,AvgMRR,AvgLogins"), "Segment")
    scaled = summaries.standardised(table, segments.FEATURES)
    spread = scaled.groupBy("Segment").agg(
        sum(F.var_pop(f"{c}Scaled") * F.count("*") for c in segments.FEATURES).alias("cost")
    )
    theirs = spread.agg(F.sum("cost")).first()[0]
    ours = segments.best_fits(segments.vectors(table.drop("Segment")), [4])[4].cost
    assert ours <= theirs * 1.001
