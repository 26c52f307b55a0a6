"""Subscription tables derived from the test tables by a fixed mapping.

The texts are plain SQL that Spark and DuckDB both accept: {name} stands for another table, so the same
mapping feeds the queries here and the checks against them. Every row of every source table is used; what
varies (price, cycle, status, spelling, date format) varies by value, nothing is filtered or sampled.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from recurra.schemas import CLEAN, RAW

SNAPSHOT = date(2001, 8, 31)
_AS_OF = f"DATE '{SNAPSHOT.isoformat()}'"

# Added to a customer id to make the id of its duplicate; above every real id.
_DUPLICATE = 1_000_000_000_000

_MONTHLY = "CASE plan_id WHEN 1 THEN 29 WHEN 2 THEN 79 ELSE 199 END"
_ANNUAL = "CASE plan_id WHEN 1 THEN 290 WHEN 2 THEN 790 ELSE 1990 END"
_TIER = "CASE plan_id WHEN 1 THEN 'Starter' WHEN 2 THEN 'Professional' ELSE 'Enterprise' END"


def _messy(day: str, selector: str) -> str:
    """A date as text in one of four formats."""
    dd = f"lpad(CAST(day({day}) AS STRING), 2, '0')"
    mm = f"lpad(CAST(month({day}) AS STRING), 2, '0')"
    yyyy = f"CAST(year({day}) AS STRING)"
    name = f"substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST((month({day}) - 1) * 3 + 1 AS INT), 3)"
    return (
        f"CASE CAST({selector} AS INT) WHEN 0 THEN CAST({day} AS STRING) || chr(9) WHEN 1 THEN {dd} || '/' || {mm} || '/' || {yyyy}"
        f" WHEN 2 THEN {dd} || '-' || {name} || '-' || {yyyy} ELSE {mm} || '/' || {dd} || '/' || {yyyy} END"
    )


def _sometimes_duplicate(row_id: str) -> str:
    """One row in fifty refers to the customer's duplicate."""
    return f"CASE WHEN {row_id} % 50 = 0 THEN customer_id + {_DUPLICATE} ELSE customer_id END"


def _plan_of(subscription: str) -> str:
    return f"CAST(CAST(floor({subscription} / 10) AS BIGINT) % 3 + 1 AS INT)"


def _cycle_of(subscription: str) -> str:
    return f"CASE WHEN {subscription} % 10 < 6 THEN 'monthly' ELSE 'annual' END"


_PLANS = f"""
SELECT plan_id, {_TIER} AS plan_name, {_TIER} AS tier,
       CAST({_MONTHLY} AS DECIMAL(10,2)) AS monthly_price, CAST({_ANNUAL} AS DECIMAL(10,2)) AS annual_price
FROM (SELECT DISTINCT CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 1 WHEN p_type IN ('STANDARD', 'MEDIUM') THEN 2
             ELSE 3 END AS plan_id FROM {{part}}) p
"""

_SUBSCRIPTIONS = f"""
SELECT subscription_id, customer_id, plan_id, start_date,
       CASE WHEN NOT stays AND runs_to <= {_AS_OF} THEN runs_to END AS end_date, billing_cycle,
       CASE WHEN NOT stays AND runs_to <= {_AS_OF} THEN 'cancelled' ELSE 'active' END AS status
FROM (SELECT o_orderkey AS subscription_id, o_custkey AS customer_id,
             {_plan_of('o_orderkey')} AS plan_id, CAST(o_orderdate AS DATE) AS start_date,
             CAST(o_orderdate AS DATE) + CAST(o_orderkey * 37 % 360 + 20 AS INT) AS runs_to,
             {_cycle_of('o_orderkey')} AS billing_cycle,
             o_orderstatus = 'O' AND CAST(o_orderdate AS DATE) >= DATE '2000-07-01' AS stays
      FROM {{orders}}) o
"""

_CUSTOMERS = """
SELECT c_custkey AS customer_id,
       CASE WHEN c_custkey % 13 = 0 THEN replace(c_name, '#', ' "') || '", LLC' ELSE replace(c_name, '#', ' ') || ' LLC' END AS company_name,
       CASE c_nationkey % 5 WHEN 0 THEN 'United States' WHEN 1 THEN 'United Kingdom' WHEN 2 THEN 'India'
            WHEN 3 THEN 'Australia' ELSE 'Canada' END AS country,
       CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN '1-10' WHEN c_custkey % 5 = 1 THEN '11-50'
            WHEN c_custkey % 5 = 2 THEN '51-200' WHEN c_custkey % 5 = 3 THEN '201-1000' ELSE '1000+' END AS company_size_band,
       coalesce(first_order - CAST(c_custkey % 45 AS INT), DATE '1995-01-01') AS signup_date,
       CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'BUILDING' THEN 'Google Ads' WHEN 'AUTOMOBILE' THEN 'Referral'
            WHEN 'HOUSEHOLD' THEN 'Organic Search' ELSE 'Direct' END AS acquisition_channel,
       FALSE AS signup_date_ambiguous
FROM {customer} LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_order FROM {orders} GROUP BY o_custkey) f
     ON f.o_custkey = c_custkey
"""

# The two quantities that spoil the amount are the outliers; the fx columns vary the raw text.
_INVOICES = f"""
SELECT l_orderkey * 10 + l_linenumber AS invoice_id, l_orderkey AS subscription_id,
       CAST(l_shipdate AS DATE) AS invoice_date,
       CAST(CAST(CASE WHEN billing_cycle = 'monthly' THEN {_MONTHLY} ELSE {_ANNUAL} END AS DECIMAL(10,2))
            * (CASE WHEN l_quantity = 1 THEN CAST(0.01 AS DECIMAL(5,2)) WHEN l_quantity = 50 THEN CAST(100 AS DECIMAL(5,2))
                    ELSE CAST(1 AS DECIMAL(5,2)) END) AS DECIMAL(12,2)) AS amount,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'failed'
            WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'refunded' ELSE 'paid' END AS payment_status,
       l_quantity IN (1, 50) AS is_outlier, l_suppkey AS fx_supp, l_partkey AS fx_part
FROM (SELECT l.*, {_plan_of('l_orderkey')} AS plan_id, {_cycle_of('l_orderkey')} AS billing_cycle FROM {{lineitem}} l) i
"""

# Shipments after the snapshot count for its month.
_USAGE = f"""
SELECT customer_id, usage_month, CAST(sum(quantity) AS BIGINT) AS login_count, count(*) AS feature_usage_count
FROM (SELECT o_custkey AS customer_id, l_quantity AS quantity,
             make_date(year(shipped), month(shipped), 1) AS usage_month
      FROM (SELECT l_orderkey, l_quantity, least(CAST(l_shipdate AS DATE), {_AS_OF}) AS shipped FROM {{lineitem}}) l
           JOIN {{orders}} ON o_orderkey = l_orderkey) u
GROUP BY customer_id, usage_month
"""

_TICKETS = """
SELECT event_id AS ticket_id, user_id AS customer_id, CAST(ts AS DATE) AS created_date,
       CASE WHEN event_id % 20 = 0 THEN NULL ELSE CAST(ts AS DATE) + CAST(event_id % 7 + 1 AS INT) END AS resolved_date,
       CASE event_id % 4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' ELSE 'Urgent' END AS priority,
       CASE event_type WHEN 'purchase' THEN 'Billing' WHEN 'error' THEN 'Bug Report' WHEN 'view' THEN 'Feature Request'
            WHEN 'signup' THEN 'Onboarding' ELSE 'Login Issue' END AS category
FROM {events}
"""

_RAW_PLANS = """
SELECT plan_id, plan_name, tier, CAST(monthly_price AS STRING) AS monthly_price,
       CAST(annual_price AS STRING) AS annual_price
FROM {plans}
"""

_RAW_CUSTOMERS = f"""
SELECT customer_id, company_name, CASE
   WHEN country = 'United States' THEN (CASE customer_id % 4 WHEN 0 THEN 'United States' WHEN 1 THEN 'USA' WHEN 2 THEN 'US' ELSE chr(9) || 'U.S.A' || chr(160) END)
   WHEN country = 'United Kingdom' THEN (CASE customer_id % 4 WHEN 0 THEN 'United Kingdom' WHEN 1 THEN 'UK' WHEN 2 THEN 'U.K.' ELSE 'Britain' END)
   WHEN country = 'India' THEN (CASE customer_id % 3 WHEN 0 THEN 'India' WHEN 1 THEN 'IN' ELSE 'Bharat' END)
   WHEN country = 'Australia' THEN (CASE customer_id % 3 WHEN 0 THEN 'Australia' WHEN 1 THEN 'AUS' ELSE 'AU' END)
   ELSE (CASE WHEN customer_id % 29 = 0 THEN 'Kanada' WHEN customer_id % 2 = 0 THEN 'Canada' ELSE 'CA' END) END AS country,
   company_size_band, {_messy('signup_date', 'customer_id % 4')} AS signup_date, acquisition_channel
FROM {{customers}}
UNION ALL
SELECT customer_id + {_DUPLICATE}, CASE CAST(floor(customer_id / 50) AS BIGINT) % 5 WHEN 0 THEN upper(company_name)
   WHEN 1 THEN lower(company_name) WHEN 2 THEN company_name || ' ' WHEN 3 THEN ' ' || company_name
   ELSE replace(company_name, 'LLC', 'L.L.C.') END,
   country, company_size_band, {_messy('signup_date', '(customer_id + 1) % 4')}, acquisition_channel
FROM {{customers}}
"""

_RAW_SUBSCRIPTIONS = f"""
SELECT subscription_id, {_sometimes_duplicate('subscription_id')} AS customer_id, plan_id,
   {_messy('start_date', 'subscription_id % 4')} AS start_date, CAST(end_date AS STRING) AS end_date, billing_cycle, status
FROM {{subscriptions}}
"""

_RAW_INVOICES = f"""
SELECT invoice_id, subscription_id, {_messy('invoice_date', 'invoice_id % 4')} AS invoice_date,
   CASE WHEN fx_part % 97 = 0 THEN 'N/A'
        WHEN fx_supp % 10 = 0 THEN '$' || (CASE WHEN amount >= 1000
               THEN CAST(CAST(floor(amount / 1000) AS BIGINT) AS STRING) || ',' || lpad(CAST(CAST(floor(amount) AS BIGINT) % 1000 AS STRING), 3, '0')
               ELSE CAST(CAST(floor(amount) AS BIGINT) AS STRING) END)
             || '.' || lpad(CAST(CAST(amount * 100 AS BIGINT) % 100 AS STRING), 2, '0')
        ELSE CAST(amount AS STRING) END AS amount, payment_status
FROM {{invoices}}
"""

_RAW_USAGE = f"""
SELECT customer_id, substr(CAST(usage_month AS STRING), 1, 7) AS month, login_count, feature_usage_count
FROM {{usage_monthly}}
UNION ALL
SELECT customer_id + {_DUPLICATE}, substr(CAST(usage_month AS STRING), 1, 7), login_count, feature_usage_count
FROM {{usage_monthly}}
"""

_RAW_TICKETS = f"""
SELECT ticket_id, {_sometimes_duplicate('ticket_id')} AS customer_id, CAST(created_date AS STRING) AS created_date,
   CAST(resolved_date AS STRING) AS resolved_date, priority, category
FROM {{support_tickets}}
"""

# Columns that are read, with their stored types; naming them spares a job per file to look them up.
SOURCES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_type string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}

# In an order in which each text only names sources and earlier tables.
MAPPING = {
    "plans": _PLANS,
    "subscriptions": _SUBSCRIPTIONS,
    "customers": _CUSTOMERS,
    "invoices": _INVOICES,
    "usage_monthly": _USAGE,
    "support_tickets": _TICKETS,
    "raw_plans": _RAW_PLANS,
    "raw_customers": _RAW_CUSTOMERS,
    "raw_subscriptions": _RAW_SUBSCRIPTIONS,
    "raw_invoices": _RAW_INVOICES,
    "raw_usage_monthly": _RAW_USAGE,
    "raw_support_tickets": _RAW_TICKETS,
}


class DerivedTables(Mapping):
    """The derived tables by name, each a lazy plan over the Parquet files in `folder`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in MAPPING:
                needed = {n: self[n] for n in (*SOURCES, *MAPPING) if "{" + n + "}" in MAPPING[name]}
                self._built[name] = self.spark.sql(MAPPING[name], **needed)
            elif name in SOURCES:
                self._built[name] = self.spark.read.schema(SOURCES[name]).parquet(f"{self._folder}/{name}.parquet")
            else:
                raise KeyError(name)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter((*SOURCES, *MAPPING))

    def __len__(self) -> int:
        return len(SOURCES) + len(MAPPING)

    def raw(self) -> dict[str, DataFrame]:
        return {name: self[f"raw_{name}"] for name in RAW}

    def clean(self) -> dict[str, DataFrame]:
        """Typed tables without the detour over raw text."""
        return {name: self[name].select(schema.names) for name, schema in CLEAN.items()}
