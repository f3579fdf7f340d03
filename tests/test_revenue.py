from collections import defaultdict
from datetime import date
from itertools import product

import pytest

from tidemark.plans import revenue


@pytest.fixture(scope="module")
def inputs(table):
    customers = table(
        "customers",
        [
            {"CustomerID": f"C{i}", "Industry": ["Media", "Retail", None][i % 3], "Country": ["Uk", "India"][i % 2],
             "AcquisitionChannel": ["Paid Ads", None][i % 2]}
            for i in range(8)
        ],
    )
    subs = table(
        "subscriptions",
        [
            {"SubscriptionID": f"S{i}", "CustomerID": f"C{i % 9}", "PlanName": ["Starter", "Growth", None][i % 3],
             "Status": ["Active", "Churned"][i // 5 % 2], "MRR": None if i == 4 else float(i)}
            for i in range(30)
        ],
    )
    return customers, subs


def test_slices_match_brute_force(inputs):
    customers, subs = inputs
    home = {r["CustomerID"]: (r["Industry"], r["Country"]) for r in customers.collect()}
    expected = defaultdict(lambda: [set(), 0, 0.0])
    for s in subs.collect():
        if s["CustomerID"] not in home:
            continue
        dims = (*home[s["CustomerID"]], s["PlanName"], s["Status"])
        for mask in product((0, 1), repeat=4):
            key = tuple(None if m else d for m, d in zip(mask, dims)) + (int("".join(map(str, mask)), 2),)
            expected[key][0].add(s["CustomerID"])
            expected[key][1] += 1
            expected[key][2] += s["MRR"] or 0.0
    found = {
        (r["Industry"], r["Country"], r["PlanName"], r["Status"], r["SliceLevel"]): (r["Customers"], r["Subscriptions"], r["TotalMRR"])
        for r in revenue.kpi_slices(customers, subs).collect()
    }
    assert found == {k: (len(c), n, total) for k, (c, n, total) in expected.items()}


def test_revenue_by_dimension_leaves_out_missing_and_orphans(inputs):
    customers, subs = inputs
    found = {r["AcquisitionChannel"]: (r["SubscriptionCount"], r["TotalMRR"], r["AverageMRR"]) for r in revenue.revenue_by_customer_dimension(customers, subs, "AcquisitionChannel").collect()}
    values = [float(i) for i in range(30) if i % 9 < 8 and (i % 9) % 2 == 0 and i != 4]
    assert found == {"Paid Ads": (len(values), sum(values), pytest.approx(sum(values) / len(values)))}


def test_revenue_by_plan(inputs):
    found = {r["PlanName"]: (r["SubscriptionCount"], r["TotalMRR"]) for r in revenue.revenue_by_plan(inputs[1]).collect()}
    assert found == {"Starter": (10, 135.0), "Growth": (9, 141.0)}  # one Growth subscription has no price


def test_pivot_fills_zero(spark):
    view = spark.createDataFrame(
        [("Media", "Starter", 1.0, "A"), ("Media", "Starter", 2.0, "B"), ("Retail", "Growth", 5.0, "C"), (None, "Growth", 9.0, "D"), ("Retail", None, 9.0, "E")],
        "Industry string, Plan string, TotalMRR double, CustomerID string",
    )
    for plans in (None, ["Growth", "Starter"]):
        found = {r["Industry"]: (r["Growth"], r["Starter"]) for r in revenue.pivot_industry_plan(view, plans).collect()}
        assert found == {"Media": (0.0, 3.0), "Retail": (5.0, 0.0)}
    summary = {r["Industry"]: (r["Customers"], r["Revenue"]) for r in revenue.industry_summary(view).collect()}
    assert summary == {"Media": (2, 3.0), "Retail": (2, 14.0)}


def test_kpis(spark):
    summary = spark.createDataFrame(
        [("A", "Churned", 10.0, 2.0, date(2024, 1, 1)), ("B", None, 0.0, 4.0, date(2024, 1, 1))],
        "CustomerID string, Status string, TotalMRR double, TenureMonths double, AnalysisDate date",
    )
    found = {r["KPI"]: r["Value"] if r["DateValue"] is None else r["DateValue"] for r in revenue.kpi_table(summary).collect()}
    assert found == {
        "Total Customers": 2.0, "Churned Customers": 1.0, "Total MRR": 10.0, "Churn Rate": 0.5,
        "Average Revenue per Account": 5.0, "Average Tenure": 3.0, "Analysis Date": date(2024, 1, 1),
    }


def test_shares(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "c string")
    found = {r["c"]: (r["n"], r["Share"]) for r in revenue.share_of_rows(df, "c", "n").collect()}
    assert found == {"x": (2, 50.0), "y": (1, 25.0), None: (1, 25.0)}


def test_a_plan_without_a_column_is_an_error(spark):
    view = spark.createDataFrame(
        [("A", "new", 5.0), ("A", "Growth", None), ("B", None, 1.0)], "Industry string, Plan string, TotalMRR double"
    )
    long = revenue.industry_plan_revenue(view).collect()
    assert sorted(tuple(r) for r in long) == [("A", "Growth", 0.0), ("A", "new", 5.0)]
    with pytest.raises(ValueError, match="new"):
        revenue.pivot_industry_plan(view, ["Growth"])
    assert revenue.pivot_industry_plan(view).columns == ["Industry", "Growth", "new"]
