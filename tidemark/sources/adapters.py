"""The four business tables, derived from the test tables.

Columns that a query does not use cost nothing: the joined parts are unique by their join key, so
Catalyst drops the whole left join when none of their columns is selected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import SOURCE

# Labels by number.
CHANNELS = ("Organic Search", "Paid Ads", "Partner", "Referral", "Outbound", "Events")
PRIORITIES = ("Low", "Medium", "High")
STATUS = {"F": "Churned", "O": "Active", "P": "Paused"}


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE[name]).parquet(f"{folder}/{name}.parquet")


def _label(number: Column, labels: tuple[str, ...]) -> Column:
    """Label by position; NULL beyond the last one."""
    return F.get(F.array(*map(F.lit, labels)), number.cast("int"))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = source(spark, folder, "customer")
    nation = source(spark, folder, "nation").dropDuplicates(["n_nationkey"])
    signup = (
        source(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").cast("date").alias("SignupDate"))
    )
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(signup, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("CustomerID"),
            F.col("c_name").alias("CompanyName"),
            F.col("c_mktsegment").alias("Industry"),
            F.col("n_name").alias("Country"),
            F.concat(F.lit("CITY "), F.col("c_nationkey"), F.lit("-"), F.col("c_custkey") % 3).alias("City"),
            F.floor(F.abs("c_acctbal")).cast("double").alias("EmployeeCount"),
            "SignupDate",
            _label(F.col("c_custkey") % 7, CHANNELS).alias("AcquisitionChannel"),
        )
    )


def subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    items = (
        source(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum("l_quantity").alias("Seats"), F.max("l_shipdate").cast("date").alias("LastDate"))
    )
    orders = source(spark, folder, "orders")
    status = F.when(F.col("o_orderstatus") == "F", STATUS["F"])
    for code in ("O", "P"):
        status = status.when(F.col("o_orderstatus") == code, STATUS[code])
    return orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("SubscriptionID"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("o_orderpriority").alias("PlanName"),
        F.when(F.col("o_orderkey") % 3 == 0, "Annual").otherwise("Monthly").alias("BillingTerm"),
        "Seats",
        F.col("o_totalprice").alias("MRR"),
        F.col("o_orderdate").cast("date").alias("StartDate"),
        F.when(F.col("o_orderstatus") == "F", F.col("LastDate")).alias("EndDate"),
        status.alias("Status"),
    )


def usage(spark: SparkSession, folder: str) -> DataFrame:
    """Usage per customer and day (the test events span one month)."""
    of_type = lambda name: F.count(F.when(F.col("event_type") == name, 1))
    return (
        source(spark, folder, "events")
        .groupBy(F.col("user_id").alias("CustomerID"), F.col("ts").cast("date").alias("Month"))
        .agg(
            of_type("view").alias("Logins"),
            of_type("click").cast("double").alias("ActiveUsers"),
            F.count(F.lit(1)).alias("APICalls"),
            F.sum("value").alias("SessionMinutes"),
        )
    )


def tickets(spark: SparkSession, folder: str) -> DataFrame:
    number = F.get_json_object("props", "$.k").cast("long")
    return (
        source(spark, folder, "events")
        .filter("event_type = 'error'")
        .select(
            F.col("event_id").alias("TicketID"),
            F.col("user_id").alias("CustomerID"),
            F.col("ts").cast("date").alias("OpenedDate"),
            (F.col("value") * 2).alias("ResolutionHours"),
            F.col("value").alias("SatisfactionScore"),
            _label(number % 3, PRIORITIES).alias("Priority"),
        )
    )


def order_activity(spark: SparkSession, folder: str) -> DataFrame:
    """Activity for cohorts: every order is activity of its customer in its month."""
    return source(spark, folder, "orders").select(
        F.col("o_custkey").alias("CustomerID"), F.col("o_orderdate").cast("date").alias("Month")
    )


def business_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "customers": customers(spark, folder),
        "subscriptions": subscriptions(spark, folder),
        "usage": usage(spark, folder),
        "tickets": tickets(spark, folder),
    }


def restricted_customers(spark: SparkSession, folder: str) -> DataFrame:
    """A customer master that lacks some nations, which leaves orphan subscriptions."""
    kept = source(spark, folder, "customer").filter("c_nationkey < 20").select(F.col("c_custkey").alias("_kept"))
    return customers(spark, folder).join(kept, F.col("CustomerID") == F.col("_kept"), "left_semi")


# --- raw tables: the same rows with duplicates, blanks, padding and mixed case put in ---------------


def _raw_key(column: str) -> Column:
    """Customer key as text, in lower case for some rows."""
    number = F.col(column)
    return F.concat(F.when(number % 2 == 0, "c").otherwise("C"), number.cast("string"))


def _with_copies(df: DataFrame, number: str) -> DataFrame:
    return df.unionByName(df.filter(F.col(number) % 50 == 0)).drop(number)


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("CustomerID")
    raw = customers(spark, folder).select(
        n.alias("_n"),
        _raw_key("CustomerID").alias("CustomerID"),
        F.when(n % 3 == 0, F.concat(F.lit("  \t"), "CompanyName", F.lit(" "))).otherwise(F.col("CompanyName")).alias("CompanyName"),
        F.when(n % 37 != 0, F.when(n % 2 == 0, F.lower("Industry")).otherwise(F.col("Industry"))).alias("Industry"),
        "Country",
        "City",
        F.when(n % 29 != 0, F.col("EmployeeCount")).alias("EmployeeCount"),
        F.col("SignupDate").cast("string").alias("SignupDate"),
        "AcquisitionChannel",
    )
    # Rows that differ from another one only in case survive the removal of exact duplicates.
    near = raw.filter(F.col("_n") % 53 == 0).withColumn("CompanyName", F.upper("CompanyName"))
    return _with_copies(raw, "_n").unionByName(near.drop("_n"))


def raw_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("SubscriptionID")
    raw = subscriptions(spark, folder).select(
        n.alias("_n"),
        F.concat(F.lit("s"), n.cast("string")).alias("SubscriptionID"),
        _raw_key("CustomerID").alias("CustomerID"),
        F.when(n % 3 == 0, F.concat(F.lit(" "), "PlanName")).otherwise(F.lower("PlanName")).alias("PlanName"),
        F.upper("BillingTerm").alias("BillingTerm"),
        F.when(n % 31 != 0, F.col("Seats")).alias("Seats"),
        F.when(n % 37 != 0, F.col("MRR")).alias("MRR"),
        F.col("StartDate").cast("string").alias("StartDate"),
        F.col("EndDate").cast("string").alias("EndDate"),
        F.concat(F.lower("Status"), F.lit("\t ")).alias("Status"),
    )
    return _with_copies(raw, "_n")


def raw_usage(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("CustomerID")
    raw = usage(spark, folder).select(
        (n + F.dayofmonth("Month")).alias("_n"),
        _raw_key("CustomerID").alias("CustomerID"),
        F.col("Month").cast("string").alias("Month"),
        "Logins",
        F.when((n + F.dayofmonth("Month")) % 37 != 0, F.col("ActiveUsers")).alias("ActiveUsers"),
        "APICalls",
        F.when((n + F.dayofmonth("Month")) % 31 != 0, F.round("SessionMinutes", 2)).alias("SessionMinutes"),
    )
    return _with_copies(raw, "_n")


def raw_tickets(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("TicketID")
    raw = tickets(spark, folder).select(
        n.alias("_n"),
        F.concat(F.lit("t-"), n.cast("string")).alias("TicketID"),
        _raw_key("CustomerID").alias("CustomerID"),
        F.col("OpenedDate").cast("string").alias("OpenedDate"),
        F.when(n % 37 != 0, F.col("ResolutionHours")).alias("ResolutionHours"),
        F.when(n % 31 != 0, F.col("SatisfactionScore")).alias("SatisfactionScore"),
        F.concat(F.upper("Priority"), F.lit(" ")).alias("Priority"),
    )
    return _with_copies(raw, "_n")
