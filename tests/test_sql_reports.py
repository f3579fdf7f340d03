import pytest

from tidemark.plans import sql_queries


@pytest.fixture(scope="module")
def tables(table):
    customers = table(
        "customers",
        [{"CustomerID": c, "CompanyName": f"N{c}", "Industry": i} for c, i in (("A", "Media"), ("B", "Media"), ("C", "Retail"), ("D", "Retail"))],
    )
    prices = [("A", 900.0), ("A", 100.0), ("B", 5000.0), ("C", 500.0), ("Z", 70.0), (None, 30.0)]
    subs = table("subscriptions", [{"SubscriptionID": f"S{i}", "CustomerID": c, "PlanName": "Growth", "MRR": m} for i, (c, m) in enumerate(prices)])
    usage = table("usage", [{"CustomerID": "A", "Logins": v, "ActiveUsers": 1.0, "SessionMinutes": 2.0} for v in (1, 2)])
    return {"customers": customers, "subscriptions": subs, "usage": usage}


def test_customer_revenue_keeps_customers_without_subscriptions(spark, tables):
    found = [(r["CustomerID"], r["TotalMRR"]) for r in sql_queries.customer_revenue(spark, tables).collect()]
    assert found == [("B", 5000.0), ("A", 1000.0), ("C", 500.0), ("D", None)]


def test_plan_revenue_counts_orphans(spark, tables):
    row = sql_queries.plan_revenue(spark, tables).first()
    assert (row["SubscriptionCount"], row["TotalMRR"], row["AverageMRR"]) == (6, 6600.0, 1100.0)


def test_industry_having(spark, tables):
    found = [(r["Industry"], r["Customers"], r["TotalMRR"]) for r in sql_queries.industry_having(spark, tables).collect()]
    assert found == [("Media", 2, 6000.0)]


def test_value_category(spark, tables, by_key):
    found = {k: v["CustomerValue"] for k, v in by_key(sql_queries.value_category(spark, tables)).items()}
    assert found == {"A": "High Value", "B": "High Value", "C": "Medium Value", "D": "Low Value"}


def test_sum_against_average_of_subscriptions(spark, tables):
    assert [r["CustomerID"] for r in sql_queries.above_average(spark, tables).collect()] == ["B"]


def test_usage_summary(spark, tables):
    found = [tuple(r) for r in sql_queries.usage_summary(spark, tables).collect()]
    assert found == [("A", "NA", 1.5, 1.0, 2.0)]


def test_rank_ties_whatever_the_order_of_the_terms(spark, table, by_key):
    parts = {"A": [0.1, 0.2, 0.3], "B": [0.3, 0.2, 0.1], "C": [0.6], "D": [9.0]}
    customers = table("customers", [{"CustomerID": c} for c in parts])
    subs = table("subscriptions", [{"SubscriptionID": f"{c}{i}", "CustomerID": c, "MRR": m} for c, p in parts.items() for i, m in enumerate(p)])
    ranked = sql_queries.revenue_rank(spark, {"customers": customers, "subscriptions": subs})
    assert {k: v["RevenueRank"] for k, v in by_key(ranked).items()} == {"D": 1, "A": 2, "B": 2, "C": 2}


def test_orphans_include_missing_keys(tables):
    found = sql_queries.orphans(tables).collect()
    assert sorted(r["SubscriptionID"] for r in found) == ["S4", "S5"]
