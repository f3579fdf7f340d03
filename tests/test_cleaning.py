from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cleaning
from tidemark.schemas import raw_schema


def _raw(spark, name, rows):
    schema = raw_schema(name)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def test_duplicates_go_before_text_is_normalised(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("A", 1), (" a", 1)], "t string, n int")
    assert sorted(r["t"] for r in cleaning.clean_base(df).collect()) == ["A", "A", "A"]


def test_cleaning_text_twice_changes_nothing(spark):
    df = spark.createDataFrame([(" o'neil UK ",), ("x-Y z",), (None,)], "t string")
    once = cleaning.clean_base(df)
    assert sorted(map(str, once.collect())) == sorted(map(str, cleaning.clean_base(once).collect()))


def test_customers(spark, by_key):
    raw = _raw(
        spark,
        "customers",
        [
            {"CustomerID": "c1", "Industry": " media", "Country": "UK", "EmployeeCount": 10.0, "SignupDate": "2023-01-04"},
            {"CustomerID": "C2", "EmployeeCount": 30.0, "SignupDate": "2023-02-04"},
            {"CustomerID": "C3", "EmployeeCount": None, "SignupDate": None},
            {"CustomerID": "C3", "EmployeeCount": None, "SignupDate": None},
        ],
    )
    found = by_key(cleaning.clean_customers(raw))
    assert set(found) == {"C1", "C2", "C3"}
    assert found["C1"]["Industry"] == "Media" and found["C1"]["Country"] == "Uk"
    assert found["C2"]["Industry"] == "Unknown" and found["C2"]["AcquisitionChannel"] is None
    assert found["C3"]["EmployeeCount"] == 20.0  # median of 10 and 30: copies count once
    assert found["C1"]["SignupDate"] == date(2023, 1, 4) and found["C3"]["SignupDate"] is None


def test_subscriptions_get_medians_dates_and_match_status(spark, by_key):
    customers = spark.createDataFrame([("C1",), ("c2",)], "CustomerID string")
    raw = _raw(
        spark,
        "subscriptions",
        [
            {"SubscriptionID": "s1", "CustomerID": "c1", "Seats": 4.0, "MRR": 10.0, "StartDate": "2024-01-01", "Status": "active "},
            {"SubscriptionID": "s2", "CustomerID": "C2", "Seats": None, "MRR": 20.0, "StartDate": "2024-01-02", "EndDate": "2024-03-01"},
            {"SubscriptionID": "s3", "CustomerID": "c9", "Seats": 8.0, "MRR": None, "StartDate": "2024-01-03"},
            {"SubscriptionID": "s4", "CustomerID": None, "Seats": 9.0, "MRR": 90.0, "StartDate": "2024-01-03"},
        ],
    )
    found = by_key(cleaning.clean_subscriptions(raw, customers), "SubscriptionID")
    assert {k: v["CustomerMatchStatus"] for k, v in found.items()} == {
        "S1": "Matched", "S2": "Matched", "S3": "Orphan", "S4": "Orphan",
    }
    assert found["S2"]["Seats"] == 8.0 and found["S3"]["MRR"] == 20.0
    assert found["S1"]["Status"] == "Active" and found["S1"]["EndDate"] is None
    assert found["S2"]["EndDate"] == date(2024, 3, 1)


def test_text_that_is_no_date_raises(spark):
    raw = _raw(spark, "usage", [{"CustomerID": "c1", "Month": "soon", "ActiveUsers": 1.0, "SessionMinutes": 1.0}])
    with pytest.raises(Exception, match="not a date"):
        cleaning.clean_usage(raw).collect()


def test_usage_and_tickets(spark, rows):
    usage = _raw(
        spark,
        "usage",
        [
            {"CustomerID": "c1", "Month": "2024-01-01", "Logins": 1, "ActiveUsers": 2.0, "SessionMinutes": None},
            {"CustomerID": "c2", "Month": "2024-01-01", "Logins": 2, "ActiveUsers": None, "SessionMinutes": 8.0},
        ],
    )
    found = rows(cleaning.clean_usage(usage), "CustomerID")
    assert [(r["CustomerID"], r["ActiveUsers"], r["SessionMinutes"]) for r in found] == [("C1", 2.0, 8.0), ("C2", 2.0, 8.0)]
    tickets = _raw(
        spark,
        "tickets",
        [
            {"TicketID": "t1", "CustomerID": "c1", "OpenedDate": "2024-01-01", "ResolutionHours": 5.0},
            {"TicketID": "t2", "CustomerID": "c1", "OpenedDate": "2024-01-02", "SatisfactionScore": 3.0},
        ],
    )
    found = rows(cleaning.clean_tickets(tickets), "TicketID")
    assert [(r["ResolutionHours"], r["SatisfactionScore"]) for r in found] == [(5.0, 3.0), (5.0, 3.0)]


def test_median_of_a_column_without_values_stays_missing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert [r["x"] for r in cleaning.fill_median(df, ["x"]).collect()] == [None, None]


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_hot_key_is_flagged_whole(spark, threshold):
    """One customer holds a third of the rows and is an orphan."""
    child = spark.range(9000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "X").otherwise(F.concat(F.lit("C"), F.col("id") % 50)).alias("CustomerID")
    )
    master = spark.range(50).select(F.concat(F.lit("c"), "id").alias("CustomerID"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        flagged = cleaning.flag_orphans(child, master)
        assert flagged.columns == ["id", "CustomerID", "CustomerMatchStatus"]
        counts = flagged.groupBy("CustomerMatchStatus").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r["CustomerMatchStatus"]: r["count"] for r in counts} == {"Matched": 6000, "Orphan": 3000}


def test_adaptive_execution_splits_a_hot_orphan_key(spark):
    """Both sides too large to broadcast: the hot key's partition is read by several tasks."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, "X").otherwise(F.concat(F.lit("c"), (F.col("id") % 500).cast("string")))
        rows = spark.range(0, 600_000, 1, 8).select(F.md5(F.col("id").cast("string")).alias("id"), key.alias("CustomerID"))
        orphans = spark.createDataFrame([("X",), ("c7",)], "CustomerID string")
        met = cleaning.meet_orphans(rows, orphans, "CustomerID", "left")
        assert met.filter("_is_orphan").count() == 200_000 + 800
        df = met.agg(F.sum(F.hash("id", "_is_orphan").cast("long")))
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
