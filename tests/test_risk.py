import pytest
from pyspark.sql import functions as F

from tidemark.plans import risk


def _inputs(table, n=40):
    customers = table("customers", [{"CustomerID": f"C{i:02}", "CompanyName": f"N{i}"} for i in range(n)])
    subs = table("subscriptions", [{"SubscriptionID": f"S{i}", "CustomerID": f"C{i:02}", "MRR": float(i)} for i in range(n)])
    usage = table(
        "usage",
        [{"CustomerID": f"C{i:02}", "Logins": i, "ActiveUsers": float(i), "SessionMinutes": float(i)} for i in range(n)],
    )
    tickets = table(
        "tickets",
        [
            {"TicketID": f"T{i}-{j}", "CustomerID": f"C{i:02}", "SatisfactionScore": float(i)}
            for i in range(n)
            for j in range(1 + (i < 10))
        ],
    )
    return customers, subs, usage, tickets


def test_levels_cover_every_score(spark):
    df = spark.createDataFrame([(s,) for s in (0, 20, 40, 60, 80, 100)], "s int")
    found = [r["l"] for r in df.select(risk.risk_level(F.col("s")).alias("l")).collect()]
    assert found == ["Minimal", "Low", "Medium", "High", "Critical", "Critical"]


def test_scores(table, by_key):
    scores = risk.risk_scores(*_inputs(table))
    found = by_key(scores)
    assert len(found) == 40
    assert {v["RiskScore"] for v in found.values()} <= {0, 20, 40, 60, 80, 100}
    assert found["C00"]["RiskScore"] == 100 and found["C09"]["RiskScore"] == 100 and found["C39"]["RiskScore"] == 0
    summary = {r["RiskLevel"]: (r["Customers"], r["TotalMRR"]) for r in risk.risk_summary(scores).collect()}
    assert summary["Critical"] == (10, 45.0) and sum(c for c, _ in summary.values()) == 40
    top = [r["CustomerID"] for r in risk.top_risk(scores, 3).collect()]
    assert top == ["C00", "C01", "C02"]


def test_missing_means_do_not_score(table, by_key):
    customers, subs, usage, tickets = _inputs(table)
    no_minutes = usage.withColumn("SessionMinutes", F.when(F.col("CustomerID") != "C00", F.col("SessionMinutes")))
    assert by_key(risk.risk_scores(customers, subs, no_minutes, tickets))["C00"]["RiskScore"] == 80


def test_flags_and_null_policy(table, by_key):
    _, subs, usage, _ = _inputs(table)
    some = usage.filter("CustomerID <> 'C39'")
    skipped = by_key(risk.customer_flags(subs, some))
    assert skipped["C39"]["HighValue"] == "Yes" and skipped["C39"]["AtRisk"] == "No"
    assert skipped["C00"]["AtRisk"] == "Yes" and skipped["C00"]["RiskScore"] == 2
    strict = by_key(risk.customer_flags(subs, some, null_policy="propagate"))
    assert {v["AtRisk"] for v in strict.values()} == {"No"} and {v["RiskScore"] for v in strict.values()} == {1}
    assert strict["C39"]["HighValue"] == "Yes"
    with pytest.raises(ValueError):
        risk.customer_flags(subs, some, null_policy="other")


def test_high_value_at_risk_scores_three(table, by_key):
    subs = table("subscriptions", [{"SubscriptionID": "S1", "CustomerID": "A", "MRR": 9.0}, {"SubscriptionID": "S2", "CustomerID": "B", "MRR": 1.0}])
    usage = table("usage", [{"CustomerID": c, "ActiveUsers": v, "SessionMinutes": v} for c, v in (("A", 1.0), ("B", 5.0))])
    found = by_key(risk.customer_flags(subs, usage))
    assert found["A"]["RiskScore"] == 3 and found["B"]["RiskScore"] == 1
