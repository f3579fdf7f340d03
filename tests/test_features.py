from datetime import date

import pytest

from tidemark.operators import features
from tidemark.operators.latest import latest_rows


def _sub(sid, cid, **more):
    return {"SubscriptionID": sid, "CustomerID": cid} | more


@pytest.fixture(scope="module")
def tables(table):
    customers = table(
        "customers",
        [
            {"CustomerID": "C1", "Industry": "Media", "SignupDate": date(2023, 1, 1)},
            {"CustomerID": "C2", "Industry": "Retail", "SignupDate": date(2024, 1, 1)},
            {"CustomerID": "C3", "Industry": None, "SignupDate": None},
        ],
    )
    subscriptions = table(
        "subscriptions",
        [
            _sub("S1", "C1", PlanName="Starter", Seats=2.0, MRR=100.0, StartDate=date(2023, 1, 1), EndDate=date(2023, 6, 1), Status="Churned"),
            _sub("S2", "C1", PlanName=None, Seats=3.0, MRR=50.0, StartDate=date(2023, 7, 1), EndDate=None, Status="Active"),
            _sub("S3", "C2", PlanName="Growth", Seats=0.0, MRR=None, StartDate=date(2024, 1, 1), EndDate=date(2024, 5, 1), Status="Paused"),
            _sub("S9", "C9", PlanName="Growth", Seats=5.0, MRR=70.0, StartDate=date(2024, 1, 1), Status="Active"),
        ],
    )
    usage = table(
        "usage",
        [
            {"CustomerID": "C1", "Month": date(2023, 1, 1), "Logins": 2, "ActiveUsers": 1.0, "APICalls": 5, "SessionMinutes": 10.0},
            {"CustomerID": "C1", "Month": date(2023, 2, 1), "Logins": 4, "ActiveUsers": None, "APICalls": 7, "SessionMinutes": 20.0},
            {"CustomerID": "C9", "Month": date(2023, 2, 1), "Logins": 9, "ActiveUsers": None, "APICalls": 1, "SessionMinutes": 1.0},
        ],
    )
    tickets = table(
        "tickets",
        [
            {"TicketID": "T1", "CustomerID": "C1", "ResolutionHours": 4.0, "SatisfactionScore": 5.0},
            {"TicketID": "T2", "CustomerID": "C1", "ResolutionHours": 6.0, "SatisfactionScore": 3.0},
            {"TicketID": "T9", "CustomerID": "C9", "ResolutionHours": 1.0, "SatisfactionScore": None},
        ],
    )
    return customers, subscriptions, usage, tickets


def test_customer_360_keeps_every_customer(tables, by_key):
    found = by_key(features.customer_360(*tables, as_of=date(2024, 1, 1)))
    assert set(found) == {"C1", "C2", "C3"}
    one, two, three = found["C1"], found["C2"], found["C3"]
    assert (one["TotalMRR"], one["Seats"], one["Plan"], one["Status"]) == (150.0, 5.0, "Starter", "Active")
    assert (one["Logins"], one["SessionMinutes"], one["Tickets"], one["Satisfaction"]) == (3.0, 15.0, 2, 4.0)
    assert one["TenureMonths"] == pytest.approx(365 / 30) and one["RevenuePerSeat"] == 30.0
    assert two["TotalMRR"] == 0.0  # all missing sums to zero
    assert two["RevenuePerSeat"] is None and two["TenureMonths"] == 0 and two["TicketsPerMonth"] is None
    assert three["TotalMRR"] is None and three["Plan"] is None and three["TenureMonths"] is None


def test_customer_360_latest_drops_customers_without_children(tables, by_key):
    found = by_key(features.customer_360_latest(*tables))
    assert set(found) == {"C1"}
    # The open subscription is the latest one.
    assert (found["C1"]["Status"], found["C1"]["LatestMRR"], found["C1"]["LatestSeats"]) == ("Active", 50.0, 3.0)
    assert (found["C1"]["AverageAPICalls"], found["C1"]["AverageResolutionHours"], found["C1"]["TicketCount"]) == (6.0, 5.0, 2)


def test_latest_by_start_and_by_end_differ(table, by_key):
    subs = table(
        "subscriptions",
        [
            _sub("S1", "C1", StartDate=date(2024, 1, 1), EndDate=None, Status="Active"),
            _sub("S2", "C1", StartDate=date(2024, 6, 1), EndDate=date(2024, 7, 1), Status="Churned"),
            _sub("S3", "C2", StartDate=date(2024, 6, 1), Status="Churned"),
            _sub("S4", "C2", StartDate=date(2024, 6, 1), Status=None),
        ],
    )
    started = by_key(features.latest_subscription(subs))
    ended = by_key(latest_rows(subs, "CustomerID", "EndDate", "SubscriptionID"))
    assert started["C1"]["SubscriptionID"] == "S2" and ended["C1"]["SubscriptionID"] == "S1"
    # Equal dates: the greater id; and the row is taken whole, missing values included.
    assert started["C2"]["SubscriptionID"] == "S4" and started["C2"]["Status"] is None


def test_customer_summary(tables, by_key):
    found = by_key(features.customer_summary(tables[0], tables[1]))
    assert found["C1"]["AnalysisDate"] == date(2024, 5, 1)
    assert found["C1"]["TenureMonths"] == round(486 / 30.44, 1) and found["C1"]["Status"] == "Active"
    assert found["C3"]["TotalMRR"] == 0.0 and found["C3"]["TenureMonths"] is None and found["C3"]["Status"] is None
    early = by_key(features.customer_summary(tables[0], tables[1], as_of=date(2023, 12, 1)))
    assert early["C2"]["TenureMonths"] == 0.0  # never below zero


def test_segment_features_keep_orphans_and_fill_zero(tables, by_key):
    found = by_key(features.segment_features(*tables[1:]))
    assert set(found) == {"C1", "C9"}
    assert found["C9"]["ActiveUsers"] == 0.0 and found["C9"]["SatisfactionScore"] == 0.0
    assert found["C1"]["MRR"] == 150.0 and found["C1"]["Seats"] == 5.0


def test_facts_can_stand_in_for_the_tables(tables, rows):
    customers, *children = tables
    facts = features.staged_facts(*children)
    day = date(2024, 1, 1)
    for made, from_facts in (
        (features.customer_360(*tables, day), features.customer_360(customers, *facts, day)),
        (features.customer_360_latest(*tables), features.customer_360_latest(customers, *facts)),
        (features.customer_summary(*tables[:2]), features.customer_summary(customers, facts[0])),
        (features.segment_features(*children), features.segment_features(*facts)),
    ):
        assert rows(made, "CustomerID") == rows(from_facts, "CustomerID")
