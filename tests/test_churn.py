import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions.student_t import incomplete_beta, two_sided_p
from tidemark.plans import churn


def test_p_value_of_known_distributions():
    assert two_sided_p(12.706204736432095, 1) == pytest.approx(0.05, rel=1e-9)
    assert two_sided_p(2.2281388519649385, 10) == pytest.approx(0.05, rel=1e-9)
    assert two_sided_p(0.0, 5) == 1.0 and two_sided_p(None, 3) is None
    assert two_sided_p(1.0, 1) == pytest.approx(0.5)  # Cauchy
    assert two_sided_p(-1.959963984540054, 1e9) == pytest.approx(0.05, rel=1e-6)  # normal
    assert incomplete_beta(2, 3, 0.4) == pytest.approx(0.5248)


def test_welch(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0, 9.0, 12.0]
    df = spark.createDataFrame([(x, True) for x in a] + [(x, False) for x in b] + [(None, True)], "x double, first boolean")
    row = churn.welch_t_test(df, "x", F.col("first")).first()
    # variances 5/3 and 15.8, means 2.5 and 6.6
    s1, s2 = 5 / 3 / 4, 15.8 / 5
    assert row["TStatistic"] == pytest.approx((2.5 - 6.6) / (s1 + s2) ** 0.5)
    assert row["DegreesOfFreedom"] == pytest.approx((s1 + s2) ** 2 / (s1**2 / 3 + s2**2 / 4))
    assert 0 < row["PValue"] < 1


def test_welch_without_enough_values(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, False), (3.0, False)], "x double, first boolean")
    assert tuple(churn.welch_t_test(df, "x", F.col("first")).first()) == (None, None, None)


def test_missing_status_counts_as_retained(table):
    statuses = ["Churned", "Churned", None, "Active"]
    subs = table("subscriptions", [{"SubscriptionID": f"S{i}", "CustomerID": f"C{i}", "StartDate": date(2024, 1, 1), "Status": s} for i, s in enumerate(statuses)])
    usage = table("usage", [{"CustomerID": f"C{i}", "Logins": v} for i, v in enumerate([1, 3, 10, 20])])
    row = churn.churn_welch_t_test(subs, usage).first()
    assert row["TStatistic"] == pytest.approx((2 - 15) / (2 / 2 + 50 / 2) ** 0.5)


def test_sample_check(table):
    subs = table("subscriptions", [{"SubscriptionID": f"S{i}", "CustomerID": f"C{i % 100}", "MRR": 1.0 + i % 100} for i in range(200)])
    first = {r["Group"]: r["Mean"] for r in churn.sample_check(subs).collect()}
    assert first["Population"] == 101.0 and first["Sample 1"] != first["Sample 2"]
    assert first == {r["Group"]: r["Mean"] for r in churn.sample_check(subs.repartition(7)).collect()}
    # Two samples that take everyone must be disjoint: their means average to the population's.
    halves = {r["Group"]: r["Mean"] for r in churn.sample_check(subs, size=50).collect()}
    assert (halves["Sample 1"] + halves["Sample 2"]) / 2 == pytest.approx(101.0)


def test_trend_and_rates(table, spark):
    subs = table(
        "subscriptions",
        [
            {"SubscriptionID": "1", "Status": "Churned", "EndDate": date(2024, 1, 3)},
            {"SubscriptionID": "2", "Status": "Churned", "EndDate": date(2024, 1, 30)},
            {"SubscriptionID": "3", "Status": "Churned", "EndDate": None},
            {"SubscriptionID": "4", "Status": "Active", "EndDate": date(2024, 1, 30)},
        ],
    )
    assert [(str(r["ChurnMonth"]), r["ChurnedSubscriptions"]) for r in churn.churn_trend(subs).collect()] == [("2024-01-01", 2)]
    view = spark.createDataFrame(
        [("Media", "Churned", 1.0), ("Media", "Active", 3.0), ("Retail", None, 5.0), (None, "Churned", 7.0)],
        "Industry string, Status string, x double",
    )
    assert [(r["Industry"], r["ChurnRate"]) for r in churn.churn_rate_by_industry(view).collect()] == [("Media", 50.0), ("Retail", 0.0)]
    assert {r["Status"]: (r["x"], r["Customers"]) for r in churn.mean_by_status(view, "x").collect()} == {"Churned": (4.0, 2), "Active": (3.0, 1)}


@pytest.mark.parametrize("degrees", [1e5, 1e7, 1e9, 1e10, 1e11, 1e12])
@pytest.mark.parametrize("t", [0.01, 1.0, 3.0, 6.0])
def test_many_degrees_of_freedom_go_to_the_normal_limit(t, degrees):
    # The first term by which the t distribution departs from the normal one.
    density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    limit = math.erfc(t / math.sqrt(2)) + 2 * density * t * (t * t + 1) / (4 * degrees)
    assert two_sided_p(t, degrees) == pytest.approx(limit, rel=max(1e-13, 2000 / degrees**2 * (1 + t**8)))


def test_expansion_and_fraction_agree_where_they_meet():
    for t in (0.1, 1.0, 2.5, 5.0):
        assert two_sided_p(t, 10_001.0) == pytest.approx(incomplete_beta(5000.5, 0.5, 10_001 / (10_001 + t * t)), rel=1e-9)
