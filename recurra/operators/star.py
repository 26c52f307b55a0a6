"""The star schema: two dimensions, five facts and the relationships between them."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.operators.churn import fact_churn_by_month
from recurra.operators.cohort import fact_cohort_retention
from recurra.operators.mrr import fact_monthly_subscription, fact_mrr_waterfall, subscription_mrr
from recurra.operators.quality import duplicate_keys, orphan_count
from recurra.operators.value import fact_customer_clv

# Facts large enough to be stored by month.
BY_MONTH = ("fact_monthly_subscription", "fact_mrr_waterfall")

_UNIQUE = (("dim_customer", "customer_id"), ("dim_plan", "plan_id"), ("fact_customer_clv", "customer_id"))
_REFERENCES = (
    ("fact_monthly_subscription", "customer_id", "dim_customer"),
    ("fact_mrr_waterfall", "customer_id", "dim_customer"),
    ("fact_customer_clv", "customer_id", "dim_customer"),
    ("fact_monthly_subscription", "plan_id", "dim_plan"),
)


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "company_name", "country", "company_size_band", "acquisition_channel", "signup_date"
    )


def dim_plan(plans: DataFrame) -> DataFrame:
    return plans.select("plan_id", "plan_name", "tier", "monthly_price", "annual_price")


def star_tables(tables: Mapping[str, DataFrame], *, snapshot: date) -> dict[str, DataFrame]:
    customers, subscriptions = tables["customers"], tables["subscriptions"]
    mrr = subscription_mrr(subscriptions, tables["plans"])
    return {
        "dim_customer": dim_customer(customers),
        "dim_plan": dim_plan(tables["plans"]),
        "fact_monthly_subscription": fact_monthly_subscription(mrr, snapshot=snapshot),
        "fact_mrr_waterfall": fact_mrr_waterfall(mrr, snapshot=snapshot),
        "fact_churn_by_month": fact_churn_by_month(mrr, snapshot=snapshot),
        "fact_cohort_retention": fact_cohort_retention(customers, subscriptions, snapshot=snapshot),
        "fact_customer_clv": fact_customer_clv(customers, subscriptions, tables["invoices"], snapshot=snapshot),
    }


def star_relationships(star: Mapping[str, DataFrame]) -> DataFrame:
    """Violations of each key and reference; the churn and retention facts relate to no dimension."""
    unique = [
        duplicate_keys(star[table], table, [key]).select(
            F.lit(f"{table}.{key} is unique").alias("relationship"), F.col("n_surplus_rows").alias("n_violations")
        )
        for table, key in _UNIQUE
    ]
    references = [
        orphan_count(star[fact], key, star[dimension], key).select(
            F.lit(f"{fact}.{key} is in {dimension}").alias("relationship"), F.col("n_orphans").alias("n_violations")
        )
        for fact, key, dimension in _REFERENCES
    ]
    return reduce(DataFrame.unionByName, unique + references)
