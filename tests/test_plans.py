"""Shape of the physical plans: what is scanned, what is shuffled, and what never goes to one task."""

import os
import re

import pytest

from tidemark.operators import features
from tidemark.plans import cohorts, revenue, risk, sql_queries
from tidemark.queries import REGISTRY
from tidemark.sources import adapters

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_unused_joined_tables_are_not_read(spark):
    total = features.revenue_by_customer(adapters.subscriptions(spark, FOLDER))
    text = plan(total)
    assert text.count("FileScan") == 1 and "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text
    assert "Join" not in text
    names = plan(adapters.customers(spark, FOLDER).select("CustomerID", "CompanyName"))
    assert names.count("FileScan") == 1 and "Join" not in names


def test_filters_reach_the_scan(spark):
    assert "EqualTo(event_type,error)" in plan(adapters.tickets(spark, FOLDER))


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - {"segments", "segment_summary", "elbow_cost"}))
def test_no_rows_go_to_a_single_task(spark, no_broadcast, name):
    """Only aggregates without a key (one row per task) may meet in one partition."""
    lines = plan(REGISTRY[name](spark, FOLDER)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1]
            assert re.search(r"Aggregate\((keys?=\[\])?.*partial_|TakeOrdered|keys=\[\]", below), below
    assert not any("CartesianProduct" in line for line in lines)


def test_children_are_aggregated_before_they_are_joined(spark, no_broadcast):
    tables = adapters.business_tables(spark, FOLDER)
    text = plan(risk.risk_features(**tables))
    # One exchange per child for its aggregate, none between the aggregates and the joins.
    joined = text[: text.index("Exchange")]
    assert joined.count("SortMergeJoin") >= 1
    customer_keys = re.findall(r"Exchange hashpartitioning\((CustomerID|c_custkey)#\w+, \d+\)", text)
    assert len(customer_keys) == 4  # customers, subscriptions, usage, tickets


def test_sql_reports_sum_before_the_join(spark, no_broadcast):
    text = plan(sql_queries.industry_having(spark, adapters.business_tables(spark, FOLDER)))
    child = text[text.index("SortMergeJoin") :]
    assert "partial_sum(MRR" in child


def test_activity_shrinks_before_the_join(spark, no_broadcast):
    text = plan(cohorts.monthly_activity(adapters.customers(spark, FOLDER), adapters.order_activity(spark, FOLDER)))
    join = text.index("Join")
    assert text.index("HashAggregate(keys=[CustomerID", join) > join


def test_slices_expand_customers_four_times_only(spark, no_broadcast):
    tables = adapters.business_tables(spark, FOLDER)
    text = plan(revenue.kpi_slices(tables["customers"], tables["subscriptions"]))
    assert text.count("+- Expand") == 2 or text.count("Expand [") == 2
    assert "count(distinct" not in text


def test_rank_of_many_rows_has_no_global_window(spark):
    tables = adapters.business_tables(spark, FOLDER)
    text = plan(sql_queries.revenue_rank(spark, tables))
    assert "SinglePartition" not in text and "Window" not in text
    assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text


def test_states_in_force_shuffle_a_large_key_by_segments(spark, no_broadcast):
    text = plan(REGISTRY["plan_at_shipment"](spark, FOLDER))
    assert re.search(r"Exchange hashpartitioning\(_key#\w+, _segment#", text)


def test_days_are_never_multiplied_by_subscriptions(spark):
    text = plan(REGISTRY["active_by_day"](spark, FOLDER))
    assert "o_orderkey" not in text and "NestedLoop" not in text  # only the staged changes are left


def test_only_the_facts_in_use_are_computed(spark):
    text = plan(features.revenue_by_customer(adapters.subscriptions(spark, FOLDER)))
    assert "max_by" not in text and "SortAggregate" not in text
    means = plan(features.usage_means(adapters.usage(spark, FOLDER), ["Logins"]))
    assert "value#" not in means[means.rindex("HashAggregate") :].split("FileScan")[0]
