"""Eight SQL reports over the relations ``customers``, ``subscriptions`` and ``usage``.

Subscriptions are summed per customer inside each statement before the join, so the join sees one
row per customer however unevenly the subscriptions are spread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.cleaning import meet_orphans, orphan_keys
from tidemark.operators.ordering import rank_descending

_REVENUE = """
    revenue AS (
        SELECT CustomerID, sum(MRR) AS MRR FROM {subscriptions} GROUP BY CustomerID
    )
"""

STATEMENTS = {
    "customer_revenue": f"""
        WITH {_REVENUE}
        SELECT CustomerID, CompanyName, Industry, sum(MRR) AS TotalMRR
        FROM {{customers}} LEFT JOIN revenue USING (CustomerID)
        GROUP BY ALL
        ORDER BY TotalMRR DESC
    """,
    "plan_revenue": """
        SELECT PlanName, count(*) AS SubscriptionCount, sum(MRR) AS TotalMRR, avg(MRR) AS AverageMRR
        FROM {subscriptions}
        GROUP BY ALL
        ORDER BY TotalMRR DESC
    """,
    "industry_having": f"""
        WITH {_REVENUE}
        SELECT Industry, count(DISTINCT CustomerID) AS Customers, sum(MRR) AS TotalMRR
        FROM {{customers}} JOIN revenue USING (CustomerID)
        GROUP BY ALL
        HAVING TotalMRR > :minimum
        ORDER BY TotalMRR DESC
    """,
    "value_category": f"""
        WITH {_REVENUE}, totals AS (
            SELECT CustomerID, CompanyName, sum(MRR) AS TotalMRR
            FROM {{customers}} LEFT JOIN revenue USING (CustomerID)
            GROUP BY ALL
        )
        SELECT *,
            CASE WHEN TotalMRR >= :high THEN 'High Value'
                 WHEN TotalMRR >= :medium THEN 'Medium Value'
                 ELSE 'Low Value' END AS CustomerValue
        FROM totals
        ORDER BY TotalMRR DESC
    """,
    "above_average": f"""
        WITH {_REVENUE}
        SELECT CustomerID, CompanyName, sum(MRR) AS TotalMRR
        FROM {{customers}} JOIN revenue USING (CustomerID)
        GROUP BY ALL
        HAVING TotalMRR > (SELECT avg(MRR) FROM {{subscriptions}})
    """,
    "usage_summary": """
        WITH activity AS (
            SELECT CustomerID, avg(Logins) AS AverageLogins, avg(ActiveUsers) AS AverageActiveUsers,
                   avg(SessionMinutes) AS AverageSessionMinutes
            FROM {usage}
            GROUP BY CustomerID
        )
        SELECT CustomerID, CompanyName, AverageLogins, AverageActiveUsers, AverageSessionMinutes
        FROM {customers} JOIN activity USING (CustomerID)
        ORDER BY AverageLogins DESC
    """,
    "customer_totals": f"""
        WITH {_REVENUE}
        SELECT CustomerID, CompanyName, sum(MRR) AS TotalMRR
        FROM {{customers}} JOIN revenue USING (CustomerID)
        GROUP BY ALL
    """,
}


def run(spark: SparkSession, tables: dict[str, DataFrame], name: str, **parameters) -> DataFrame:
    """The tables enter as arguments of the statement, so views that a user has under their names are left alone."""
    used = {k: df for k, df in tables.items() if f"{{{k}}}" in STATEMENTS[name]}
    return spark.sql(STATEMENTS[name], args=parameters, **used)


def customer_revenue(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    return run(spark, tables, "customer_revenue")


def plan_revenue(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    return run(spark, tables, "plan_revenue")


def industry_having(spark: SparkSession, tables: dict[str, DataFrame], minimum: float = 5000) -> DataFrame:
    return run(spark, tables, "industry_having", minimum=minimum)


def value_category(
    spark: SparkSession, tables: dict[str, DataFrame], high: float = 1000, medium: float = 500
) -> DataFrame:
    return run(spark, tables, "value_category", high=high, medium=medium)


def above_average(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    return run(spark, tables, "above_average")


def usage_summary(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    return run(spark, tables, "usage_summary")


def revenue_rank(spark: SparkSession, tables: dict[str, DataFrame], **rank_options) -> DataFrame:
    """Rank of every customer by total revenue.

    A floating sum depends on the order of its terms, so totals are compared at four decimals:
    equal totals then tie whatever order they were summed in.
    """
    totals = run(spark, tables, "customer_totals").withColumn("_total", F.round("TotalMRR", 4))
    return rank_descending(totals, "_total", "CustomerID", "RevenueRank", **rank_options).drop("_total")


def orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Subscriptions whose customer is not in the master."""
    subscriptions = tables["subscriptions"].select("SubscriptionID", "CustomerID", "PlanName", "MRR")
    missing = orphan_keys(subscriptions, tables["customers"])
    return meet_orphans(subscriptions, missing, "CustomerID", "left_semi")
