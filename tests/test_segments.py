import random

import pytest

from tidemark.plans import segments

# Centres of four clear groups: revenue, seats, logins, active users, minutes, satisfaction.
GROUPS = {
    "High Value": (5000, 10, 10, 10, 200, 4),
    "Support Heavy": (300, 5, 10, 5, 150, 1),
    "Growing Users": (400, 5, 30, 20, 400, 5),
    "Low Engagement": (350, 5, 1, 1, 20, 5),
}


@pytest.fixture(scope="module")
def features(spark):
    pick = random.Random(1)
    rows = [
        (f"{name}-{i}", *[c + pick.gauss(0, 0.03) * (c + 1) for c in centre])
        for name, centre in GROUPS.items()
        for i in range(30)
    ]
    return spark.createDataFrame(rows, ["CustomerID", *segments.FEATURES])


def test_segments_are_named_by_their_centres(features):
    found = segments.segments(features, restarts=4).collect()
    assert len(found) == 120
    for row in found:
        assert row["Segment"] == row["CustomerID"].split("-")[0]


def test_given_names_and_summary(features):
    named = segments.segments(features, restarts=4, names={0: "a", 1: "b", 2: "c"})
    summary = {r["Segment"]: r["Customers"] for r in segments.segment_summary(named).collect()}
    assert summary == {"a": 30, "b": 30, "c": 30}  # the fourth cluster has no name


def test_elbow_falls(features):
    costs = [r["Cost"] for r in segments.elbow_cost(segments.vectors(features), restarts=3).orderBy("K").collect()]
    assert len(costs) == 5 and costs == sorted(costs, reverse=True)
    assert costs[2] < costs[1] / 3  # four real groups
