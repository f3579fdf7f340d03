"""Fixed schemas of the four business tables and of the test tables they are derived from."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    """Schema from "name type, …"; unlike ``StructType.fromDDL`` it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BUSINESS = {
    "customers": _struct(
        "CustomerID string, CompanyName string, Industry string, Country string, City string, "
        "EmployeeCount double, SignupDate date, AcquisitionChannel string"
    ),
    "subscriptions": _struct(
        "SubscriptionID string, CustomerID string, PlanName string, BillingTerm string, Seats double, "
        "MRR double, StartDate date, EndDate date, Status string"
    ),
    "usage": _struct(
        "CustomerID string, Month date, Logins bigint, ActiveUsers double, APICalls bigint, "
        "SessionMinutes double"
    ),
    "tickets": _struct(
        "TicketID string, CustomerID string, OpenedDate date, ResolutionHours double, "
        "SatisfactionScore double, Priority string"
    ),
}

SOURCE = {
    "nation": _struct("n_nationkey int, n_name string, n_regionkey int"),
    "customer": _struct(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "orders": _struct(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": _struct(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": _struct(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def raw_schema(name: str) -> T.StructType:
    """Schema of a raw file: dates are still text, to be parsed by the cleaning step."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType)
            for f in BUSINESS[name].fields
        ]
    )
