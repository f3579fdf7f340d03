from datetime import date

import pytest

from tidemark.plans import cohorts


@pytest.fixture(scope="module")
def inputs(table):
    customers = table(
        "customers",
        [
            {"CustomerID": "A", "SignupDate": date(2023, 1, 20)},
            {"CustomerID": "B", "SignupDate": date(2023, 1, 5)},
            {"CustomerID": "C", "SignupDate": date(2023, 12, 31)},
            {"CustomerID": "D", "SignupDate": None},
        ],
    )
    activity = [
        ("A", 2023, 1), ("A", 2023, 2), ("A", 2023, 2), ("B", 2023, 2), ("B", 2022, 12),  # before signup
        ("C", 2024, 1), ("D", 2023, 5), ("X", 2023, 1),  # no cohort; not a customer
    ]
    usage = table("usage", [{"CustomerID": c, "Month": date(y, m, 1)} for c, y, m in activity])
    return customers, usage


def test_retention(inputs):
    found = {(str(r["Cohort"]), r["MonthNo"]): (r["ActiveCustomers"], r["CohortSize"], r["RetentionRate"]) for r in cohorts.cohort_retention(*inputs).collect()}
    assert found == {
        ("2023-01-01", 0): (1, 2, 50.0),
        ("2023-01-01", 1): (2, 2, 100.0),
        ("2023-12-01", 1): (1, 1, 100.0),
    }


def test_curve_divides_by_all_customers(inputs):
    found = [(r["MonthNo"], r["ActiveCustomers"], r["RetentionRate"]) for r in cohorts.retention_curve(*inputs).collect()]
    assert found == [(0, 1, 25.0), (1, 3, 75.0)]


def test_matrix(inputs):
    retention = cohorts.cohort_retention(*inputs)
    matrix = {str(r["Cohort"]): (r["0"], r["1"]) for r in cohorts.retention_matrix(retention).collect()}
    assert matrix == {"2023-01-01": (50.0, 100.0), "2023-12-01": (None, 100.0)}
    assert len(cohorts.retention_matrix(retention, at_least=5).columns) == 6


def test_matrix_of_a_mistyped_year_is_an_error(spark):
    rows = [(date(2023, 1, 1), 0, 1.0), (date(2023, 1, 1), 95_723, 1.0)]
    retention = spark.createDataFrame(rows, "Cohort date, MonthNo int, RetentionRate double")
    with pytest.raises(ValueError, match="month number 95723"):
        cohorts.retention_matrix(retention)


def test_sketches_give_the_curve(inputs):
    estimated = cohorts.approximate_curve(cohorts.activity_sketches(*inputs))
    exact = cohorts.retention_curve(*inputs).select("MonthNo", "ActiveCustomers")
    assert sorted(map(tuple, estimated.collect())) == sorted(map(tuple, exact.collect()))


def test_best_and_worst(inputs, spark):
    retention = cohorts.cohort_retention(*inputs)
    found = {r["Category"]: (r["Cohort"], r["RetentionRate"]) for r in cohorts.best_and_worst_cohort(retention).collect()}
    # Equal rates: the earliest cohort for both.
    assert found == {"Best Cohort": ("2023-01", 100.0), "Worst Cohort": ("2023-01", 100.0)}
    rows = [(date(2023, m, 1), 1, r) for m, r in ((1, 50.0), (2, 90.0), (3, 10.0), (4, 90.0), (5, 10.0))]
    other = spark.createDataFrame(rows, "Cohort date, MonthNo int, RetentionRate double")
    found = {r["Category"]: r["Cohort"] for r in cohorts.best_and_worst_cohort(other).collect()}
    assert found == {"Best Cohort": "2023-02", "Worst Cohort": "2023-03"}


def test_repeated_customer_counts_once(table):
    customers = table("customers", [{"CustomerID": "A", "SignupDate": date(2023, 1, 1), "City": c} for c in "xy"])
    usage = table("usage", [{"CustomerID": "A", "Month": date(2023, 1, d)} for d in (1, 2, 3)])
    found = [(r["ActiveCustomers"], r["CohortSize"]) for r in cohorts.cohort_retention(customers, usage).collect()]
    assert found == [(1, 1)]
