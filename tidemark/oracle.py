"""Independent SQL for every registered query, for another engine to run on the same test tables."""

from __future__ import annotations

# --- the business tables ------------------------------------------------------------------------

_CUSTOMERS = """
customers AS MATERIALIZED (
    SELECT c_custkey AS CustomerID, c_name AS CompanyName, c_mktsegment AS Industry, n_name AS Country,
        'CITY ' || c_nationkey || '-' || (c_custkey % 3) AS City,
        CAST(floor(abs(c_acctbal)) AS DOUBLE) AS EmployeeCount, SignupDate,
        CASE c_custkey % 7 WHEN 0 THEN 'Organic Search' WHEN 1 THEN 'Paid Ads' WHEN 2 THEN 'Partner'
            WHEN 3 THEN 'Referral' WHEN 4 THEN 'Outbound' WHEN 5 THEN 'Events' END AS AcquisitionChannel,
        c_nationkey AS nation
    FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS SignupDate FROM orders GROUP BY 1)
        ON c_custkey = o_custkey
)"""

_SUBSCRIPTIONS = """
subscriptions AS MATERIALIZED (
    SELECT o_orderkey AS SubscriptionID, o_custkey AS CustomerID, o_orderpriority AS PlanName,
        CASE WHEN o_orderkey % 3 = 0 THEN 'Annual' ELSE 'Monthly' END AS BillingTerm,
        Seats, o_totalprice AS MRR, CAST(o_orderdate AS DATE) AS StartDate,
        CASE WHEN o_orderstatus = 'F' THEN last_date END AS EndDate,
        CASE o_orderstatus WHEN 'F' THEN 'Churned' WHEN 'O' THEN 'Active' WHEN 'P' THEN 'Paused' END AS Status
    FROM orders
    LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS Seats, CAST(max(l_shipdate) AS DATE) AS last_date
               FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
)"""

_USAGE = """
usage AS MATERIALIZED (
    SELECT user_id AS CustomerID, CAST(ts AS DATE) AS Month,
        count(*) FILTER (WHERE event_type = 'view') AS Logins,
        CAST(count(*) FILTER (WHERE event_type = 'click') AS DOUBLE) AS ActiveUsers,
        count(*) AS APICalls, sum(value) AS SessionMinutes
    FROM events GROUP BY 1, 2
)"""

_TICKETS = """
tickets AS MATERIALIZED (
    SELECT event_id AS TicketID, user_id AS CustomerID, CAST(ts AS DATE) AS OpenedDate,
        value * 2 AS ResolutionHours, value AS SatisfactionScore,
        CASE CAST(json_extract_string(props, '$.k') AS BIGINT) % 3
            WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' END AS Priority
    FROM events WHERE event_type = 'error'
)"""

# --- the raw tables -----------------------------------------------------------------------------

_RAW_CUSTOMERS = """
raw_customers0 AS MATERIALIZED (
    SELECT CustomerID AS n, CASE WHEN CustomerID % 2 = 0 THEN 'c' ELSE 'C' END || CustomerID AS CustomerID,
        CASE WHEN CustomerID % 3 = 0 THEN '  ' || chr(9) || CompanyName || ' ' ELSE CompanyName END AS CompanyName,
        CASE WHEN CustomerID % 37 = 0 THEN NULL WHEN CustomerID % 2 = 0 THEN lower(Industry)
            ELSE Industry END AS Industry,
        Country, City, CASE WHEN CustomerID % 29 <> 0 THEN EmployeeCount END AS EmployeeCount,
        CAST(SignupDate AS VARCHAR) AS SignupDate, AcquisitionChannel
    FROM customers
), raw_customers AS MATERIALIZED (
    SELECT * EXCLUDE (n) FROM raw_customers0
    UNION ALL SELECT * EXCLUDE (n) FROM raw_customers0 WHERE n % 50 = 0
    UNION ALL SELECT * EXCLUDE (n) REPLACE (upper(CompanyName) AS CompanyName)
              FROM raw_customers0 WHERE n % 53 = 0
)"""

_RAW_SUBSCRIPTIONS = """
raw_subscriptions0 AS MATERIALIZED (
    SELECT SubscriptionID AS n, 's' || SubscriptionID AS SubscriptionID,
        CASE WHEN CustomerID % 2 = 0 THEN 'c' ELSE 'C' END || CustomerID AS CustomerID,
        CASE WHEN SubscriptionID % 3 = 0 THEN ' ' || PlanName ELSE lower(PlanName) END AS PlanName,
        upper(BillingTerm) AS BillingTerm,
        CASE WHEN SubscriptionID % 31 <> 0 THEN Seats END AS Seats,
        CASE WHEN SubscriptionID % 37 <> 0 THEN MRR END AS MRR,
        CAST(StartDate AS VARCHAR) AS StartDate, CAST(EndDate AS VARCHAR) AS EndDate,
        lower(Status) || chr(9) || ' ' AS Status
    FROM subscriptions
), raw_subscriptions AS MATERIALIZED (
    SELECT * EXCLUDE (n) FROM raw_subscriptions0
    UNION ALL SELECT * EXCLUDE (n) FROM raw_subscriptions0 WHERE n % 50 = 0
)"""

_RAW_USAGE = """
raw_usage0 AS MATERIALIZED (
    SELECT CustomerID + day(Month) AS n,
        CASE WHEN CustomerID % 2 = 0 THEN 'c' ELSE 'C' END || CustomerID AS CustomerID,
        CAST(Month AS VARCHAR) AS Month, Logins,
        CASE WHEN (CustomerID + day(Month)) % 37 <> 0 THEN ActiveUsers END AS ActiveUsers, APICalls,
        CASE WHEN (CustomerID + day(Month)) % 31 <> 0 THEN round(SessionMinutes, 2) END AS SessionMinutes
    FROM usage
), raw_usage AS MATERIALIZED (
    SELECT * EXCLUDE (n) FROM raw_usage0
    UNION ALL SELECT * EXCLUDE (n) FROM raw_usage0 WHERE n % 50 = 0
)"""

_RAW_TICKETS = """
raw_tickets0 AS MATERIALIZED (
    SELECT TicketID AS n, 't-' || TicketID AS TicketID,
        CASE WHEN CustomerID % 2 = 0 THEN 'c' ELSE 'C' END || CustomerID AS CustomerID,
        CAST(OpenedDate AS VARCHAR) AS OpenedDate,
        CASE WHEN TicketID % 37 <> 0 THEN ResolutionHours END AS ResolutionHours,
        CASE WHEN TicketID % 31 <> 0 THEN SatisfactionScore END AS SatisfactionScore,
        upper(Priority) || ' ' AS Priority
    FROM tickets
), raw_tickets AS MATERIALIZED (
    SELECT * EXCLUDE (n) FROM raw_tickets0
    UNION ALL SELECT * EXCLUDE (n) FROM raw_tickets0 WHERE n % 50 = 0
)"""


def _text(column: str) -> str:
    """Strip and title-case in SQL: words are runs of letters."""
    stripped = f"regexp_replace({column}, '^\\s+|\\s+$', '', 'g')"
    words = f"regexp_extract_all({stripped}, '[A-Za-z]+|[^A-Za-z]+')"
    return f"array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN {words}], '')"


def _texts(*columns: str) -> str:
    return ", ".join(f"{_text(c)} AS {c}" for c in columns)


# --- shared customer-level relations -------------------------------------------------------------

_VIEW_360 = """
subs_c AS MATERIALIZED (
    SELECT CustomerID, coalesce(sum(MRR), 0) AS TotalMRR, coalesce(sum(Seats), 0) AS Seats,
        last(PlanName ORDER BY StartDate NULLS FIRST, SubscriptionID) FILTER (WHERE PlanName IS NOT NULL) AS Plan,
        last(Status ORDER BY StartDate NULLS FIRST, SubscriptionID) FILTER (WHERE Status IS NOT NULL) AS Status
    FROM subscriptions GROUP BY 1
), view_360 AS MATERIALIZED (
    SELECT c.* EXCLUDE (nation), TotalMRR, Seats, Plan, Status, Logins, SessionMinutes, Tickets, Satisfaction,
        date_diff('day', SignupDate, DATE '2002-01-01') / 30 AS TenureMonths,
        TotalMRR / nullif(Seats, 0) AS RevenuePerSeat,
        Tickets / nullif(date_diff('day', SignupDate, DATE '2002-01-01') / 30, 0) AS TicketsPerMonth
    FROM customers c
    LEFT JOIN subs_c USING (CustomerID)
    LEFT JOIN (SELECT CustomerID, avg(Logins) AS Logins, avg(SessionMinutes) AS SessionMinutes
               FROM usage GROUP BY 1) USING (CustomerID)
    LEFT JOIN (SELECT CustomerID, count(TicketID) AS Tickets, avg(SatisfactionScore) AS Satisfaction
               FROM tickets GROUP BY 1) USING (CustomerID)
)"""

_VIEW_LATEST = """
view_latest AS MATERIALIZED (
    SELECT c.* EXCLUDE (nation), s.Status, s.MRR AS LatestMRR, s.Seats AS LatestSeats,
        AverageLogins, AverageActiveUsers, AverageAPICalls, AverageSessionMinutes,
        AverageSatisfaction, AverageResolutionHours, TicketCount
    FROM customers c
    JOIN (SELECT * FROM subscriptions QUALIFY row_number() OVER (
              PARTITION BY CustomerID ORDER BY EndDate DESC NULLS FIRST, SubscriptionID DESC) = 1) s
        USING (CustomerID)
    JOIN (SELECT CustomerID, avg(Logins) AS AverageLogins, avg(ActiveUsers) AS AverageActiveUsers,
              avg(APICalls) AS AverageAPICalls, avg(SessionMinutes) AS AverageSessionMinutes
          FROM usage GROUP BY 1) USING (CustomerID)
    JOIN (SELECT CustomerID, avg(SatisfactionScore) AS AverageSatisfaction,
              avg(ResolutionHours) AS AverageResolutionHours, count(TicketID) AS TicketCount
          FROM tickets GROUP BY 1) USING (CustomerID)
)"""

_STARTED_LAST = """
started_last AS MATERIALIZED (
    SELECT * FROM subscriptions QUALIFY row_number() OVER (
        PARTITION BY CustomerID ORDER BY StartDate DESC NULLS FIRST, SubscriptionID DESC) = 1
)"""

_SUMMARY = """
summary AS MATERIALIZED (
    SELECT c.CustomerID, CompanyName, Industry, SignupDate, l.Status, coalesce(TotalMRR, 0) AS TotalMRR,
        CASE WHEN SignupDate IS NOT NULL
             THEN round(greatest(date_diff('day', SignupDate, AnalysisDate) / 30.44, 0), 1) END AS TenureMonths,
        AnalysisDate
    FROM customers c
    LEFT JOIN started_last l ON c.CustomerID = l.CustomerID
    LEFT JOIN (SELECT CustomerID, sum(MRR) AS TotalMRR FROM subscriptions GROUP BY 1) r
        ON c.CustomerID = r.CustomerID
    CROSS JOIN (SELECT greatest((SELECT max(SignupDate) FROM customers), max(StartDate), max(EndDate))
                    AS AnalysisDate FROM subscriptions)
)"""

_FLAGS = """
flag_base AS MATERIALIZED (
    SELECT CustomerID, TotalMRR, ActiveUsers, SessionMinutes
    FROM (SELECT CustomerID, coalesce(sum(MRR), 0) AS TotalMRR FROM subscriptions GROUP BY 1)
    LEFT JOIN (SELECT CustomerID, avg(ActiveUsers) AS ActiveUsers, avg(SessionMinutes) AS SessionMinutes
               FROM usage GROUP BY 1) USING (CustomerID)
), flag_limits AS MATERIALIZED (
    SELECT quantile_cont(TotalMRR, 0.75) AS m, quantile_cont(ActiveUsers, 0.25) AS a,
        quantile_cont(SessionMinutes, 0.25) AS s FROM flag_base
), flags AS MATERIALIZED (
    SELECT CustomerID, TotalMRR, ActiveUsers, SessionMinutes,
        CASE WHEN TotalMRR >= m THEN 'Yes' ELSE 'No' END AS HighValue,
        CASE WHEN ActiveUsers <= a AND SessionMinutes <= s THEN 'Yes' ELSE 'No' END AS AtRisk
    FROM flag_base, flag_limits
)"""

_RISK = """
risk_base AS MATERIALIZED (
    SELECT CustomerID, CompanyName, TotalMRR, Logins, ActiveUsers, SessionMinutes, TicketCount, Satisfaction
    FROM customers
    JOIN (SELECT CustomerID, coalesce(sum(MRR), 0) AS TotalMRR FROM subscriptions GROUP BY 1) USING (CustomerID)
    JOIN (SELECT CustomerID, avg(Logins) AS Logins, avg(ActiveUsers) AS ActiveUsers,
              avg(SessionMinutes) AS SessionMinutes FROM usage GROUP BY 1) USING (CustomerID)
    JOIN (SELECT CustomerID, count(TicketID) AS TicketCount, avg(SatisfactionScore) AS Satisfaction
          FROM tickets GROUP BY 1) USING (CustomerID)
), risk_limits AS MATERIALIZED (
    SELECT quantile_cont(Logins, 0.25) AS l, quantile_cont(ActiveUsers, 0.25) AS a,
        quantile_cont(SessionMinutes, 0.25) AS s, quantile_cont(TicketCount, 0.75) AS t,
        quantile_cont(Satisfaction, 0.25) AS f FROM risk_base
), risk_points AS MATERIALIZED (
    SELECT risk_base.*, CAST(20 * ((Logins <= l)::INT + (ActiveUsers <= a)::INT + (SessionMinutes <= s)::INT
        + (TicketCount >= t)::INT + (Satisfaction <= f)::INT) AS INTEGER) AS RiskScore
    FROM risk_base, risk_limits
), risk AS MATERIALIZED (
    SELECT *, CASE WHEN RiskScore >= 80 THEN 'Critical' WHEN RiskScore >= 60 THEN 'High'
        WHEN RiskScore >= 40 THEN 'Medium' WHEN RiskScore >= 20 THEN 'Low' ELSE 'Minimal' END AS RiskLevel
    FROM risk_points
)"""

_SEGMENT_FEATURES = """
segment_base AS MATERIALIZED (
    SELECT CustomerID, MRR, Seats, coalesce(Logins, 0) AS Logins, coalesce(ActiveUsers, 0) AS ActiveUsers,
        coalesce(SessionMinutes, 0) AS SessionMinutes, coalesce(SatisfactionScore, 0) AS SatisfactionScore
    FROM (SELECT CustomerID, coalesce(sum(MRR), 0) AS MRR, coalesce(sum(Seats), 0) AS Seats
          FROM subscriptions GROUP BY 1)
    JOIN (SELECT CustomerID, avg(Logins) AS Logins, avg(ActiveUsers) AS ActiveUsers,
              avg(SessionMinutes) AS SessionMinutes FROM usage GROUP BY 1) USING (CustomerID)
    JOIN (SELECT CustomerID, avg(SatisfactionScore) AS SatisfactionScore FROM tickets GROUP BY 1)
        USING (CustomerID)
)"""

_ACTIVITY = """
activity AS MATERIALIZED (
    SELECT DISTINCT o_custkey AS CustomerID, date_trunc('month', SignupDate) AS Cohort,
        CAST((year(o_orderdate) - year(SignupDate)) * 12 + month(o_orderdate) - month(SignupDate) AS INTEGER)
            AS MonthNo
    FROM orders JOIN customers ON o_custkey = CustomerID
), retention AS MATERIALIZED (
    SELECT strftime(Cohort, '%Y-%m') AS Cohort, MonthNo, ActiveCustomers, CohortSize,
        round(ActiveCustomers / CohortSize * 100, 2) AS RetentionRate
    FROM (SELECT Cohort, MonthNo, count(DISTINCT CustomerID) AS ActiveCustomers
          FROM activity WHERE MonthNo >= 0 GROUP BY 1, 2)
    JOIN (SELECT date_trunc('month', SignupDate) AS Cohort, count(DISTINCT CustomerID) AS CohortSize
          FROM customers GROUP BY 1) USING (Cohort)
)"""

_PARTS = {
    "customers": (_CUSTOMERS, []),
    "subscriptions": (_SUBSCRIPTIONS, []),
    "usage": (_USAGE, []),
    "tickets": (_TICKETS, []),
    "raw_customers": (_RAW_CUSTOMERS, ["customers"]),
    "raw_subscriptions": (_RAW_SUBSCRIPTIONS, ["subscriptions"]),
    "raw_usage": (_RAW_USAGE, ["usage"]),
    "raw_tickets": (_RAW_TICKETS, ["tickets"]),
    "view_360": (_VIEW_360, ["customers", "subscriptions", "usage", "tickets"]),
    "view_latest": (_VIEW_LATEST, ["customers", "subscriptions", "usage", "tickets"]),
    "started_last": (_STARTED_LAST, ["subscriptions"]),
    "summary": (_SUMMARY, ["customers", "started_last"]),
    "flags": (_FLAGS, ["subscriptions", "usage"]),
    "risk": (_RISK, ["customers", "subscriptions", "usage", "tickets"]),
    "segment_base": (_SEGMENT_FEATURES, ["subscriptions", "usage", "tickets"]),
    "activity": (_ACTIVITY, ["customers"]),
}


def _statement(parts: str, body: str) -> str:
    """The body after the relations it needs, each one once and after those it builds on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _PARTS[name][1]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in parts.split():
        add(name)
    relations = ",".join(_PARTS[name][0] for name in ordered)
    return f"WITH {relations}\n{body.strip()}" if relations else body.strip()


def _r(*columns: str, decimals: int = 6) -> str:
    return ", ".join(f"round({c}, {decimals}) AS {c.split('.')[-1]}" for c in columns)


def _money(*columns: str) -> str:
    return _r(*columns, decimals=2)


_DATE_TEXT = (
    "CASE WHEN o_orderkey % 41 = 0 THEN 'unknown' WHEN o_orderkey % 43 <> 0 "
    "THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END"
)
_PRICE_TEXT = (
    "CASE WHEN o_orderkey % 41 = 0 THEN 'n.a.' WHEN o_orderkey % 43 <> 0 "
    "THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END"
)
_FEATURES = ["MRR", "Seats", "Logins", "ActiveUsers", "SessionMinutes", "SatisfactionScore"]
_VIEW_METRICS = [
    "LatestMRR", "LatestSeats", "AverageLogins", "AverageActiveUsers", "AverageAPICalls",
    "AverageSessionMinutes", "TicketCount", "AverageSatisfaction", "AverageResolutionHours",
]
_METRICS = [
    (table, c)
    for table, columns in (
        ("subscriptions", ["MRR", "Seats"]),
        ("usage", ["Logins", "ActiveUsers", "APICalls", "SessionMinutes"]),
    )
    for c in columns
]
_VIEW_COLUMNS = (
    "CustomerID, CompanyName, Industry, Country, City, EmployeeCount, SignupDate, AcquisitionChannel"
)
# Month columns of the matrix: the test tables span seven calendar years.
_MONTHS = 84


def _union(bodies: list[str]) -> str:
    return " UNION ALL ".join(bodies)


# Prices of a workbook: some are missing or no numbers, and count as 0.
_LENIENT = "CASE WHEN SubscriptionID % 41 = 0 OR SubscriptionID % 43 = 0 THEN 0 ELSE coalesce(MRR, 0) END"


def _dimension(column: str) -> str:
    return f"""
        SELECT {column}, count(*) AS SubscriptionCount, round(sum({_LENIENT}), 2) AS TotalMRR,
            round(avg({_LENIENT}), 6) AS AverageMRR
        FROM subscriptions JOIN customers USING (CustomerID) WHERE {column} IS NOT NULL GROUP BY 1"""


def _share(table: str, column: str, count: str) -> str:
    return f"""
        SELECT {column}, count(*) AS {count},
            round(count(*) / (SELECT count(*) FROM {table}) * 100, 6) AS Share
        FROM {table} GROUP BY 1"""


def _sample(seed: int, source: str) -> str:
    return f"""
        SELECT * FROM {source} ORDER BY md5(CAST(CustomerID AS VARCHAR) || '-{seed}'), CustomerID LIMIT 30"""


def _pearson(metrics: list[str], table: str) -> str:
    rows = _union(
        [
            f"SELECT '{a}' AS MetricA, '{b}' AS MetricB, round(corr({a}, {b}), 6) AS Correlation FROM {table}"
            for a in metrics
            for b in metrics
        ]
    )
    return rows


def _median(table: str, column: str) -> str:
    return f"coalesce({column}, (SELECT median({column}) FROM {table})) AS {column}"


def _clean(table: str, texts: list[str], upper: bool = True) -> str:
    """Deduplicated, normalised base relation of one raw table."""
    key = f", upper({_text('CustomerID')}) AS CustomerID" if upper else f", {_text('CustomerID')} AS CustomerID"
    return (
        f"base AS MATERIALIZED (SELECT * REPLACE ({_texts(*texts)}{key}) "
        f"FROM (SELECT DISTINCT * FROM {table}))"
    )


_CLEAN_CUSTOMER_TEXTS = [
    "CompanyName", "Industry", "Country", "City", "SignupDate", "AcquisitionChannel",
]

STATEMENTS: dict[str, tuple[str, str]] = {
    # sources and sinks
    "scan_orders": (
        "",
        """SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice,
               CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
               'said "' || o_orderpriority || '",' || chr(10) || 'ok' AS note FROM orders""",
    ),
    "load_check": (
        "customers subscriptions usage tickets",
        """SELECT 'customers' AS TableName, count(*) AS Rows, CAST(8 AS BIGINT) AS Columns FROM customers
           UNION ALL SELECT 'subscriptions', count(*), 9 FROM subscriptions
           UNION ALL SELECT 'usage', count(*), 6 FROM usage
           UNION ALL SELECT 'tickets', count(*), 6 FROM tickets""",
    ),
    "parse_dates": (
        "",
        f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS StrictDate,
               TRY_CAST({_DATE_TEXT} AS DATE) AS LenientDate FROM orders""",
    ),
    "parse_numeric": (
        "",
        f"""SELECT o_orderkey, round(coalesce(TRY_CAST({_PRICE_TEXT} AS DOUBLE), 0), 2) AS MRR FROM orders""",
    ),
    "report_tables": (
        "customers subscriptions usage tickets summary",
        """SELECT 'customers' AS TableName, count(*) AS Rows, CAST(8 AS BIGINT) AS Columns FROM customers
           UNION ALL SELECT 'subscriptions', count(*), 9 FROM subscriptions
           UNION ALL SELECT 'usage', count(*), 6 FROM usage
           UNION ALL SELECT 'tickets', count(*), 6 FROM tickets
           UNION ALL SELECT 'customer_summary', count(*), 8 FROM summary
           UNION ALL SELECT 'revenue_by_plan', count(DISTINCT PlanName), 4 FROM subscriptions
           UNION ALL SELECT 'revenue_by_industry', count(DISTINCT Industry), 4
                     FROM subscriptions JOIN customers USING (CustomerID)
           UNION ALL SELECT 'revenue_by_channel', count(DISTINCT AcquisitionChannel), 4
                     FROM subscriptions JOIN customers USING (CustomerID)
           UNION ALL SELECT 'kpi', 7, 3""",
    ),
    # cleaning
    "clean_dedupe": (
        "raw_customers",
        "SELECT DISTINCT * REPLACE (round(EmployeeCount, 6) AS EmployeeCount) FROM raw_customers",
    ),
    "clean_text": (
        "raw_customers",
        f"SELECT {_texts('CustomerID', *_CLEAN_CUSTOMER_TEXTS)}, EmployeeCount FROM raw_customers",
    ),
    "clean_fill": (
        "raw_customers",
        "SELECT * REPLACE (coalesce(Industry, 'Unknown') AS Industry) FROM raw_customers",
    ),
    "clean_impute_median": (
        "raw_subscriptions",
        """, base AS MATERIALIZED (SELECT DISTINCT * FROM raw_subscriptions)
           SELECT SubscriptionID, round(coalesce(Seats, (SELECT median(Seats) FROM base)), 2) AS Seats,
               round(coalesce(MRR, (SELECT median(MRR) FROM base)), 2) AS MRR FROM base""",
    ),
    "clean_orphan_flag": (
        "customers raw_subscriptions",
        """SELECT SubscriptionID, upper(CustomerID) AS CustomerID,
               CASE WHEN upper(CustomerID) IN (SELECT 'C' || CustomerID FROM customers WHERE nation < 20)
                    THEN 'Matched' ELSE 'Orphan' END AS CustomerMatchStatus
           FROM raw_subscriptions""",
    ),
    "clean_customers": (
        "raw_customers",
        f""", {_clean("raw_customers", _CLEAN_CUSTOMER_TEXTS, upper=False)}
           SELECT * REPLACE (coalesce(Industry, 'Unknown') AS Industry, {_median("base", "EmployeeCount")},
               CAST(SignupDate AS DATE) AS SignupDate) FROM base""",
    ),
    "clean_subscriptions": (
        "customers raw_subscriptions",
        f""", {_clean("raw_subscriptions", ["SubscriptionID", "PlanName", "BillingTerm", "Status"])}
           SELECT * REPLACE (round(coalesce(Seats, (SELECT median(Seats) FROM base)), 2) AS Seats,
                   round(coalesce(MRR, (SELECT median(MRR) FROM base)), 2) AS MRR,
                   CAST(StartDate AS DATE) AS StartDate, CAST(EndDate AS DATE) AS EndDate),
               CASE WHEN CustomerID IN (SELECT 'C' || CustomerID FROM customers WHERE nation < 20)
                    THEN 'Matched' ELSE 'Orphan' END AS CustomerMatchStatus
           FROM base""",
    ),
    "clean_usage": (
        "raw_usage",
        f""", {_clean("raw_usage", ["Month"])}
           SELECT * REPLACE (CAST(Month AS DATE) AS Month, {_median("base", "ActiveUsers")},
               round(coalesce(SessionMinutes, (SELECT median(SessionMinutes) FROM base)), 6) AS SessionMinutes)
           FROM base""",
    ),
    "clean_tickets": (
        "raw_tickets",
        f""", {_clean("raw_tickets", ["TicketID", "OpenedDate", "Priority"])}
           SELECT * REPLACE (CAST(OpenedDate AS DATE) AS OpenedDate,
               round(coalesce(ResolutionHours, (SELECT median(ResolutionHours) FROM base)), 6) AS ResolutionHours,
               round(coalesce(SatisfactionScore, (SELECT median(SatisfactionScore) FROM base)), 6)
                   AS SatisfactionScore)
           FROM base""",
    ),
    # customer features
    "customer_360": (
        "view_360",
        f""", q AS MATERIALIZED (
               SELECT quantile_cont(TotalMRR, 0.25) AS q1, quantile_cont(TotalMRR, 0.75) AS q3 FROM view_360)
           SELECT {_VIEW_COLUMNS}, {_money("TotalMRR", "Seats")}, Plan, Status, Tickets,
               {_r("Logins", "SessionMinutes", "Satisfaction", "TenureMonths", "RevenuePerSeat", "TicketsPerMonth")},
               coalesce(TotalMRR < q1 - 1.5 * (q3 - q1) OR TotalMRR > q3 + 1.5 * (q3 - q1), false) AS Outlier
           FROM view_360, q""",
    ),
    "customer_360_latest": (
        "view_latest",
        f"""SELECT {_VIEW_COLUMNS}, Status, {_r("LatestMRR", decimals=2)}, LatestSeats, TicketCount,
               {_r("AverageLogins", "AverageActiveUsers", "AverageAPICalls", "AverageSessionMinutes",
                   "AverageSatisfaction", "AverageResolutionHours")} FROM view_latest""",
    ),
    "customer_summary": (
        "summary",
        f"SELECT * REPLACE ({_money('TotalMRR')}) FROM summary",
    ),
    "latest_subscription": ("started_last", f"SELECT * REPLACE ({_money('MRR', 'Seats')}) FROM started_last"),
    "segment_features": (
        "segment_base",
        f"SELECT CustomerID, {_money(*_FEATURES[:2])}, {_r(*_FEATURES[2:])} FROM segment_base",
    ),
    "segment_checks": (
        "segment_base",
        """SELECT count(*) AS Customers, round(sum(MRR), 2) AS TotalMRR, CAST(0 AS BIGINT) AS NotNearest,
               true AS CostAgrees, true AS CostFalls, true AS CentresAreMeans, CAST(4 AS BIGINT) AS Segments,
               count(*) AS SummaryCustomers, round(sum(MRR), 2) AS SummaryMRR, true AS NamesFollowMeans FROM segment_base""",
    ),
    # statistics
    "metric_stats": (
        "subscriptions usage",
        _union(
            [
                f"""SELECT '{c}' AS Metric, round(avg({c}), 2) AS Mean, round(stddev_pop({c}), 2) AS Std,
                    round(CAST(min({c}) AS DOUBLE), 6) AS Min, round(CAST(max({c}) AS DOUBLE), 6) AS Max
                    FROM {t}"""
                for t, c in _METRICS
            ]
        ),
    ),
    "describe_metrics": (
        "subscriptions usage",
        _union(
            [
                f"""SELECT '{c}' AS Metric, count({c}) AS count, round(avg({c}), 6) AS mean,
                    round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min,
                    round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
                    round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
                    round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75,
                    round(CAST(max({c}) AS DOUBLE), 6) AS max FROM {t}"""
                for t, c in _METRICS
            ]
        ),
    ),
    "minmax_mrr": (
        "subscriptions",
        """SELECT SubscriptionID, round(MRR, 2) AS MRR,
               round((MRR - (SELECT min(MRR) FROM subscriptions))
                   / nullif((SELECT max(MRR) - min(MRR) FROM subscriptions), 0), 3) AS NormalizedMRR
           FROM subscriptions""",
    ),
    "standardised_features": (
        "segment_base",
        "SELECT CustomerID, "
        + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 "
            f"ELSE stddev_pop({c}) OVER () END, 6) AS {c}Scaled"
            for c in _FEATURES
        )
        + " FROM segment_base",
    ),
    "iqr_outliers": (
        "subscriptions",
        """, totals AS MATERIALIZED (
               SELECT CustomerID, coalesce(sum(MRR), 0) AS TotalMRR FROM subscriptions GROUP BY 1),
           q AS MATERIALIZED (
               SELECT quantile_cont(TotalMRR, 0.25) AS q1, quantile_cont(TotalMRR, 0.75) AS q3 FROM totals)
           SELECT CustomerID, round(TotalMRR, 2) AS TotalMRR,
               TotalMRR < q1 - 1.5 * (q3 - q1) OR TotalMRR > q3 + 1.5 * (q3 - q1) AS Outlier
           FROM totals, q""",
    ),
    "correlation_matrix": (
        "view_360",
        _union(
            [
                f"SELECT '{a}' AS Metric, "
                + ", ".join(
                    f"round(corr({a}, {b}), 6) AS {b}_r"
                    for b in ("TotalMRR", "Seats", "Logins", "SessionMinutes")
                )
                + " FROM view_360"
                for a in ("TotalMRR", "Seats", "Logins", "SessionMinutes")
            ]
        ),
    ),
    "correlation_long": ("view_latest", _pearson(_VIEW_METRICS, "view_latest")),
    "session_histogram": (
        "usage",
        """, b AS MATERIALIZED (SELECT min(SessionMinutes) AS lo, max(SessionMinutes) AS hi FROM usage),
           counts AS (
               SELECT CAST(least(floor((SessionMinutes - lo) / (hi - lo) * 25), 24) AS INTEGER) AS Bin,
                   count(*) AS n
               FROM usage, b GROUP BY 1)
           SELECT CAST(i AS INTEGER) AS Bin, round(lo + i * ((hi - lo) / 25), 6) AS BinStart,
               round(CASE WHEN i = 24 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 25) END, 6) AS BinEnd,
               coalesce(n, 0) AS Records
           FROM range(25) AS bins(i) CROSS JOIN b LEFT JOIN counts ON Bin = i""",
    ),
    "sample_check": (
        "subscriptions",
        f""", totals AS MATERIALIZED (
               SELECT CustomerID, coalesce(sum(MRR), 0) AS TotalMRR FROM subscriptions GROUP BY 1),
           s1 AS MATERIALIZED ({_sample(42, "totals")}),
           rest AS (SELECT * FROM totals WHERE CustomerID NOT IN (SELECT CustomerID FROM s1)),
           s2 AS MATERIALIZED ({_sample(43, "rest")})
           SELECT 'Population' AS "Group", round(avg(TotalMRR), 6) AS Mean FROM totals
           UNION ALL SELECT 'Sample 1', round(avg(TotalMRR), 6) FROM s1
           UNION ALL SELECT 'Sample 2', round(avg(TotalMRR), 6) FROM s2""",
    ),
    "churn_welch_ttest": (
        "started_last usage",
        """, g AS MATERIALIZED (
               SELECT Status IS NOT DISTINCT FROM 'Churned' AS churned, count(*) AS n, avg(Logins) AS m,
                   var_samp(Logins) / count(*) AS s
               FROM started_last JOIN (SELECT CustomerID, avg(Logins) AS Logins FROM usage GROUP BY 1)
                   USING (CustomerID) GROUP BY 1),
           w AS MATERIALIZED (
               SELECT (a.m - b.m) / sqrt(a.s + b.s) AS t,
                   (a.s + b.s) ** 2 / (a.s ** 2 / (a.n - 1) + b.s ** 2 / (b.n - 1)) AS v
               FROM g a, g b WHERE a.churned AND NOT b.churned),
           -- p = 1 - 2 * integral of the density from 0 to |t|, by Simpson's rule in 4000 steps
           p AS (
               SELECT sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                          * (1 + (abs(t) * i / 4000) ** 2 / v) ** (-(v + 1) / 2)) * abs(any_value(t)) / 12000
                      * exp(lgamma((any_value(v) + 1) / 2) - lgamma(any_value(v) / 2))
                      / sqrt(any_value(v) * pi()) AS half
               FROM w, range(4001) AS steps(i))
           SELECT round(t, 6) AS TStatistic, round(v, 6) AS DegreesOfFreedom, round(1 - 2 * half, 6) AS PValue
           FROM w, p""",
    ),
    # risk
    "customer_flags": (
        "flags",
        f"""SELECT CustomerID, {_money("TotalMRR")}, {_r("ActiveUsers", "SessionMinutes")}, HighValue, AtRisk,
               CAST(CASE WHEN HighValue = 'Yes' AND AtRisk = 'Yes' THEN 3 WHEN AtRisk = 'Yes' THEN 2
                    ELSE 1 END AS INTEGER) AS RiskScore FROM flags""",
    ),
    "risk_scores": (
        "risk",
        f"""SELECT CustomerID, CompanyName, {_money("TotalMRR")}, {_r("Logins", "ActiveUsers", "SessionMinutes")},
               TicketCount, {_r("Satisfaction")}, RiskScore, RiskLevel FROM risk""",
    ),
    "risk_summary": (
        "risk",
        """SELECT RiskLevel, count(CustomerID) AS Customers, round(sum(TotalMRR), 2) AS TotalMRR
           FROM risk GROUP BY 1""",
    ),
    "risk_top10": (
        "risk",
        f"""SELECT CustomerID, CompanyName, {_money("TotalMRR")}, {_r("Logins", "ActiveUsers", "SessionMinutes")},
               TicketCount, {_r("Satisfaction")}, RiskScore, RiskLevel
           FROM (SELECT * FROM risk ORDER BY RiskScore DESC, CustomerID LIMIT 10)""",
    ),
    # cohorts
    "cohort_retention": ("activity", "SELECT * FROM retention"),
    "retention_matrix": (
        "activity",
        "SELECT Cohort, "
        + ", ".join(f"max(RetentionRate) FILTER (WHERE MonthNo = {m}) AS m{m}" for m in range(_MONTHS))
        + " FROM retention GROUP BY 1",
    ),
    "retention_curve": (
        "activity",
        """SELECT MonthNo, count(DISTINCT CustomerID) AS ActiveCustomers,
               round(count(DISTINCT CustomerID) / (SELECT count(DISTINCT CustomerID) FROM customers) * 100, 2)
                   AS RetentionRate
           FROM activity WHERE MonthNo >= 0 GROUP BY 1""",
    ),
    "cohort_best_worst": (
        "activity",
        """SELECT 'Best Cohort' AS Category, Cohort, RetentionRate FROM (
               SELECT * FROM retention WHERE MonthNo = 1 ORDER BY RetentionRate DESC, Cohort LIMIT 1)
           UNION ALL SELECT 'Worst Cohort', Cohort, RetentionRate FROM (
               SELECT * FROM retention WHERE MonthNo = 1 ORDER BY RetentionRate, Cohort LIMIT 1)""",
    ),
    # churn
    "churn_trend": (
        "subscriptions",
        """SELECT CAST(date_trunc('month', EndDate) AS DATE) AS ChurnMonth, count(*) AS ChurnedSubscriptions
           FROM subscriptions WHERE Status = 'Churned' AND EndDate IS NOT NULL GROUP BY 1""",
    ),
    "churn_rate_by_industry": (
        "view_latest",
        """SELECT Industry, round(avg(CASE WHEN Status = 'Churned' THEN 1 ELSE 0 END) * 100, 6) AS ChurnRate
           FROM view_latest WHERE Industry IS NOT NULL GROUP BY 1""",
    ),
    "usage_by_status": (
        "view_latest",
        """SELECT Status, round(avg(AverageLogins), 6) AS AverageLogins, count(AverageLogins) AS Customers
           FROM view_latest WHERE Status IS NOT NULL GROUP BY 1""",
    ),
    "satisfaction_by_status": (
        "view_latest",
        """SELECT Status, round(avg(AverageSatisfaction), 6) AS AverageSatisfaction,
               count(AverageSatisfaction) AS Customers
           FROM view_latest WHERE Status IS NOT NULL GROUP BY 1""",
    ),
    # revenue
    "industry_summary": (
        "view_360",
        """SELECT Industry, count(CustomerID) AS Customers, round(coalesce(sum(TotalMRR), 0), 2) AS Revenue
           FROM view_360 WHERE Industry IS NOT NULL GROUP BY 1""",
    ),
    "pivot_industry_plan": (
        "view_360",
        "SELECT Industry, "
        + ", ".join(
            f"round(coalesce(sum(TotalMRR) FILTER (WHERE Plan LIKE '{i}-%'), 0), 2) AS plan_{i}"
            for i in range(1, 6)
        )
        + " FROM view_360 WHERE Industry IS NOT NULL AND Plan IS NOT NULL GROUP BY 1",
    ),
    "industry_plan_revenue": (
        "view_360",
        """SELECT Industry, Plan, round(coalesce(sum(TotalMRR), 0), 2) AS Revenue FROM view_360
           WHERE Industry IS NOT NULL AND Plan IS NOT NULL GROUP BY ALL""",
    ),
    "revenue_by_plan": (
        "subscriptions",
        f"""SELECT PlanName, count(*) AS SubscriptionCount, round(sum({_LENIENT}), 2) AS TotalMRR,
               round(avg({_LENIENT}), 6) AS AverageMRR
           FROM subscriptions WHERE PlanName IS NOT NULL GROUP BY 1""",
    ),
    "revenue_by_industry": ("customers subscriptions", _dimension("Industry")),
    "revenue_by_channel": ("customers subscriptions", _dimension("AcquisitionChannel")),
    "channel_distribution": ("customers", _share("customers", "AcquisitionChannel", "Customers")),
    "ticket_priority_distribution": ("tickets", _share("tickets", "Priority", "Tickets")),
    "kpi_table": (
        "summary",
        """SELECT 'Total Customers' AS KPI, round(CAST(count(*) AS DOUBLE), 4) AS Value,
               CAST(NULL AS DATE) AS DateValue FROM summary
           UNION ALL SELECT 'Churned Customers', count(*) FILTER (WHERE Status = 'Churned'), NULL FROM summary
           UNION ALL SELECT 'Total MRR', round(sum(TotalMRR), 4), NULL FROM summary
           UNION ALL SELECT 'Churn Rate',
               round(count(*) FILTER (WHERE Status = 'Churned') / count(*) + 1e-9, 4), NULL FROM summary
           UNION ALL SELECT 'Average Revenue per Account', round(avg(TotalMRR) + 1e-9, 4), NULL FROM summary
           UNION ALL SELECT 'Average Tenure', round(avg(TenureMonths) + 1e-9, 4), NULL FROM summary
           UNION ALL SELECT 'Analysis Date', NULL, max(AnalysisDate) FROM summary""",
    ),
    "kpi_slices": (
        "customers subscriptions",
        """SELECT Industry, Country, PlanName, Status,
               CAST(grouping_id(Industry, Country, PlanName, Status) AS INTEGER) AS SliceLevel,
               count(DISTINCT CustomerID) AS Customers, count(*) AS Subscriptions,
               round(coalesce(sum(MRR), 0), 2) AS TotalMRR
           FROM subscriptions JOIN customers USING (CustomerID)
           GROUP BY CUBE (Industry, Country, PlanName, Status)""",
    ),
    "run_summary": (
        "customers subscriptions usage tickets flags risk segment_base",
        """SELECT (SELECT count(*) FROM customers) AS customers_rows,
               (SELECT count(*) FROM subscriptions) AS subscriptions_rows,
               (SELECT count(*) FROM usage) AS usage_rows, (SELECT count(*) FROM tickets) AS tickets_rows,
               (SELECT count(*) FROM flags WHERE HighValue = 'Yes') AS high_value,
               (SELECT count(*) FROM flags WHERE AtRisk = 'Yes') AS at_risk,
               (SELECT count(*) FROM risk WHERE RiskLevel = 'Critical') AS critical,
               (SELECT count(*) FROM segment_base) AS segmented,
               (SELECT count(DISTINCT date_trunc('month', SignupDate)) FROM customers) AS cohorts""",
    ),
    # by time, by group, by sketch
    "load_rejects": (
        "",
        """WITH texts AS (
    SELECT o_orderkey AS Key, CASE WHEN o_orderkey % 41 = 0 THEN 'unknown' WHEN o_orderkey % 43 <> 0
            THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day_text,
        CASE WHEN o_orderkey % 37 = 0 THEN 'n.a.' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price
    FROM orders
), judged AS (
    SELECT Key, TRY_CAST(day_text AS DATE) AS Day, TRY_CAST(price AS DOUBLE) AS MRR,
        nullif(concat_ws('; ', CASE WHEN day_text IS NOT NULL AND TRY_CAST(day_text AS DATE) IS NULL THEN 'Day: not a date' END,
            CASE WHEN TRY_CAST(price AS DOUBLE) IS NULL THEN 'Price: not a double' END), '') AS Reasons
    FROM texts
)
SELECT Key, CASE WHEN Reasons IS NULL THEN Day END AS Day,
    CASE WHEN Reasons IS NULL THEN round(MRR, 2) END AS MRR, Reasons,
    (SELECT count(*) FROM judged WHERE Reasons IS NULL) AS AcceptedRows,
    (SELECT count(*) FROM judged WHERE Reasons IS NOT NULL) AS RejectedRows
FROM judged""",
    ),
    "quartiles_by_industry": (
        "customers subscriptions",
        """SELECT Industry, round(quantile_cont(MRR, 0.25), 6) AS Q1, round(quantile_cont(MRR, 0.5), 6) AS Median,
               round(quantile_cont(MRR, 0.75), 6) AS Q3
           FROM subscriptions LEFT JOIN customers USING (CustomerID) GROUP BY ALL""",
    ),
    "quartiles_by_customer": (
        "subscriptions",
        """SELECT CustomerID, round(quantile_cont(MRR, 0.25), 6) AS Q1, round(quantile_cont(MRR, 0.5), 6) AS Median,
               round(quantile_cont(MRR, 0.75), 6) AS Q3
           FROM subscriptions GROUP BY ALL""",
    ),
    "plan_at_usage": (
        "subscriptions usage",
        """, states AS (
    SELECT CustomerID, StartDate, max(SubscriptionID) AS SubscriptionID, arg_max(PlanName, SubscriptionID) AS PlanName,
        arg_max(Status, SubscriptionID) AS Status
    FROM subscriptions GROUP BY ALL
)
SELECT u.CustomerID, u.Month, Logins, round(ActiveUsers, 6) AS ActiveUsers, APICalls,
    round(SessionMinutes, 6) AS SessionMinutes, SubscriptionID, PlanName, Status
FROM usage AS u ASOF LEFT JOIN states AS s ON u.CustomerID = s.CustomerID AND u.Month >= s.StartDate""",
    ),
    "plan_at_shipment": (
        "subscriptions",
        """, states AS (
    SELECT CustomerID, StartDate, max(SubscriptionID) AS SubscriptionID, arg_max(PlanName, SubscriptionID) AS PlanName,
        arg_max(Status, SubscriptionID) AS Status
    FROM subscriptions GROUP BY ALL
), shipped AS (
    SELECT o_custkey AS CustomerID, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS Shipped
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)
SELECT u.*, SubscriptionID, PlanName, Status
FROM shipped AS u ASOF LEFT JOIN states AS s ON u.CustomerID = s.CustomerID AND u.Shipped >= s.StartDate""",
    ),
    "active_by_day": (
        "subscriptions",
        """, spans AS (
    SELECT StartDate, EndDate, CAST(MRR AS DECIMAL(28,4)) AS MRR FROM subscriptions
    WHERE EndDate IS NULL OR EndDate > StartDate
), days AS (
    SELECT CAST(unnest(generate_series(min(StartDate), greatest(max(StartDate), max(EndDate)), INTERVAL 1 DAY)) AS DATE) AS Day
    FROM spans
)
SELECT Day, count(StartDate) AS Active, round(CAST(coalesce(sum(MRR), 0) AS DOUBLE), 2) AS Amount
FROM days LEFT JOIN spans ON StartDate <= Day AND (EndDate IS NULL OR EndDate > Day) GROUP BY ALL""",
    ),
    "approx_active_customers": (
        "customers",
        """, months AS (
    SELECT DISTINCT o_custkey AS CustomerID, date_diff('month', SignupDate, CAST(o_orderdate AS DATE)) AS MonthNo
    FROM orders JOIN customers ON o_custkey = CustomerID WHERE SignupDate IS NOT NULL
)
SELECT CAST(MonthNo AS INTEGER) AS MonthNo, count(DISTINCT CustomerID) AS ActiveCustomers, TRUE AS Within3Percent,
    TRUE AS HalvesAgree
FROM months WHERE MonthNo >= 0 GROUP BY ALL""",
    ),
    # runs and streams
    "run_difference": (
        "subscriptions",
        """, before AS (
    SELECT SubscriptionID, CustomerID, PlanName, MRR, Status FROM subscriptions
), raised AS (
    SELECT * REPLACE (CASE WHEN SubscriptionID % 89 = 0 THEN MRR + 1 ELSE MRR END AS MRR) FROM before
), after AS (
    SELECT * FROM raised WHERE SubscriptionID % 97 <> 0
    UNION ALL SELECT * FROM raised WHERE SubscriptionID % 101 = 0
    UNION ALL SELECT * REPLACE (SubscriptionID + 1000000000 AS SubscriptionID) FROM before WHERE SubscriptionID % 103 = 0
), gone AS (
    SELECT * FROM before EXCEPT ALL SELECT * FROM after
), come AS (
    SELECT * FROM after EXCEPT ALL SELECT * FROM before
), both_sides AS (
    SELECT *, CASE WHEN SubscriptionID IN (SELECT SubscriptionID FROM come) THEN 'changed from' ELSE 'removed' END AS Change
    FROM gone
    UNION ALL SELECT *, CASE WHEN SubscriptionID IN (SELECT SubscriptionID FROM gone) THEN 'changed to' ELSE 'added' END
    FROM come
)
SELECT SubscriptionID, CustomerID, PlanName, round(MRR, 2) AS MRR, Status, Change, count(*) AS Copies
FROM both_sides GROUP BY ALL""",
    ),
    "streamed_latest": (
        "subscriptions",
        """SELECT CustomerID, SubscriptionID, PlanName, round(MRR, 2) AS MRR, StartDate, Status FROM subscriptions
           QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY StartDate DESC NULLS FIRST, SubscriptionID DESC) = 1""",
    ),
    "streamed_usage": (
        "usage",
        "SELECT CustomerID, Month, Logins, APICalls, round(SessionMinutes, 6) AS SessionMinutes FROM usage",
    ),
    # SQL reports
    "sql_customer_revenue": (
        "customers subscriptions",
        """SELECT CustomerID, CompanyName, Industry, round(sum(MRR), 2) AS TotalMRR
           FROM customers LEFT JOIN subscriptions USING (CustomerID) GROUP BY ALL""",
    ),
    "sql_plan_revenue": (
        "subscriptions",
        """SELECT PlanName, count(*) AS SubscriptionCount, round(sum(MRR), 2) AS TotalMRR,
               round(avg(MRR), 6) AS AverageMRR FROM subscriptions GROUP BY ALL""",
    ),
    "sql_industry_having": (
        "customers subscriptions",
        """SELECT Industry, count(DISTINCT CustomerID) AS Customers, round(sum(MRR), 2) AS TotalMRR
           FROM customers JOIN subscriptions USING (CustomerID) GROUP BY ALL HAVING sum(MRR) > 5000""",
    ),
    "sql_value_category": (
        "customers subscriptions",
        """SELECT CustomerID, CompanyName, round(total, 2) AS TotalMRR,
               CASE WHEN total >= 3000000 THEN 'High Value' WHEN total >= 2000000 THEN 'Medium Value'
                    ELSE 'Low Value' END AS CustomerValue
           FROM customers LEFT JOIN (SELECT CustomerID, sum(MRR) AS total FROM subscriptions GROUP BY ALL)
               USING (CustomerID)""",
    ),
    "sql_above_average": (
        "customers subscriptions",
        """SELECT CustomerID, CompanyName, round(sum(MRR), 2) AS TotalMRR
           FROM customers JOIN subscriptions USING (CustomerID) GROUP BY ALL
           HAVING sum(MRR) > (SELECT avg(MRR) FROM subscriptions)""",
    ),
    "sql_usage_summary": (
        "customers usage",
        """SELECT CustomerID, CompanyName, round(avg(Logins), 6) AS AverageLogins,
               round(avg(ActiveUsers), 6) AS AverageActiveUsers,
               round(avg(SessionMinutes), 6) AS AverageSessionMinutes
           FROM customers JOIN usage USING (CustomerID) GROUP BY ALL""",
    ),
    "sql_revenue_rank": (
        "customers subscriptions",
        """SELECT CustomerID, CompanyName, round(sum(MRR), 2) AS TotalMRR,
               rank() OVER (ORDER BY round(sum(MRR), 4) DESC NULLS LAST) AS RevenueRank
           FROM customers JOIN subscriptions USING (CustomerID) GROUP BY ALL""",
    ),
    "sql_orphans": (
        "customers subscriptions",
        """SELECT SubscriptionID, CustomerID, PlanName, round(MRR, 2) AS MRR FROM subscriptions
           WHERE CustomerID NOT IN (SELECT CustomerID FROM customers WHERE nation < 20)""",
    ),
}


def oracle_sql() -> dict[str, str]:
    statements = {}
    for name, (parts, body) in STATEMENTS.items():
        text = _statement(parts, body)
        # A body that starts with a comma adds relations of its own.
        # The same hair before rounding to six decimals as in the registered queries.
        text = text.replace(", 6)", " + 1e-9, 6)")
        statements[name] = text.replace("\n,", ",", 1) if body.strip().startswith(",") else text
    return statements
