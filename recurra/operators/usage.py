"""Usage signals: revenue at risk, and usage before a cancellation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions.dates import months_apart
from recurra.functions.money import from_cents, rounded_ratio, to_cents
from recurra.operators.joins import with_scalar

CHURNED = "Churned (ever)"
NEVER_CHURNED = "Never churned"


def _with_trailing(usage: DataFrame, rows: int, *carried: str) -> DataFrame:
    """Add the sum and the count of the logins of the preceding rows (rows, not calendar months); keep columns `carried`."""
    before = Window.partitionBy("customer_id").orderBy("usage_month").rowsBetween(-rows, -1)
    return (
        usage.select("customer_id", "usage_month", "login_count", *carried)
        .withColumn("trailing_sum", F.sum("login_count").over(before))
        .withColumn("trailing_rows", F.count("login_count").over(before))
    )


def trailing_usage(usage: DataFrame, *, rows: int = 5) -> DataFrame:
    average = F.col("trailing_sum").cast("double") / F.nullif("trailing_rows", F.lit(0))
    return _with_trailing(usage, rows).select(
        "customer_id", "usage_month", "login_count", average.alias("trailing_avg_logins")
    )


def revenue_at_risk(usage: DataFrame, customers: DataFrame, mrr: DataFrame, *, top: int = 20) -> DataFrame:
    """Customers whose logins in the latest month are under half their trailing average, by MRR at stake.

    Ties in MRR go to the lower customer_id.
    """
    latest = usage.agg(F.max("usage_month").alias("latest_month"))
    logins, total, n = F.col("login_count"), F.col("trailing_sum"), F.col("trailing_rows")
    at_stake = (
        mrr.where(F.col("status") == "active").groupBy("customer_id").agg(F.sum(to_cents(F.col("mrr"))).alias("cents"))
    )
    # Only usage of customers with something at stake is put in order.
    usage_at_stake = usage.join(at_stake, "customer_id")
    # logins < total / n / 2, in whole numbers
    declining = with_scalar(_with_trailing(usage_at_stake, 5, "cents"), latest).where(
        (F.col("usage_month") == F.col("latest_month")) & (logins * n * 2 < total)
    )
    names = customers.select("customer_id", "company_name")
    return (
        declining.join(names, "customer_id")
        .orderBy(F.col("cents").desc(), "customer_id")
        .limit(top)
        .select(
            "customer_id", "company_name", F.col("login_count").alias("latest_logins"),
            rounded_ratio(total, n, 1).alias("trailing_avg_logins"),
            rounded_ratio((logins * n - total) * 100, total, 1).alias("pct_change_in_usage"),
            from_cents(F.col("cents")).alias("at_risk_mrr"),
        )
    )


def _last_cancellations(subscriptions: DataFrame) -> DataFrame:
    cancelled = subscriptions.where(F.col("status") == "cancelled")
    return cancelled.groupBy("customer_id").agg(F.max("end_date").alias("churned_on"))


def usage_churn_group(usage: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Usage rows labelled by whether the customer ever cancelled a subscription."""
    cancelled = _last_cancellations(subscriptions).select("customer_id", F.lit(CHURNED).alias("label"))
    return usage.join(cancelled, "customer_id", "left").select(
        "customer_id", "usage_month", "login_count", F.coalesce("label", F.lit(NEVER_CHURNED)).alias("group_label")
    )


def _logins_before_churn(usage: DataFrame, subscriptions: DataFrame, months: int) -> DataFrame:
    """months_before_churn, logins, n."""
    dated = usage.join(_last_cancellations(subscriptions), "customer_id")
    before = months_apart(F.col("churned_on"), F.col("usage_month"))
    return (
        dated.withColumn("months_before_churn", before)
        .where(F.col("months_before_churn").between(0, months))
        .groupBy("months_before_churn")
        .agg(F.sum("login_count").alias("logins"), F.count("login_count").alias("n"))
    )


def usage_before_churn(usage: DataFrame, subscriptions: DataFrame, *, months: int = 6) -> DataFrame:
    """Mean logins by months before the customer's last cancellation, furthest first."""
    average = F.col("logins").cast("double") / F.nullif("n", F.lit(0))
    return (
        _logins_before_churn(usage, subscriptions, months)
        .select("months_before_churn", average.alias("avg_logins"))
        .orderBy(F.col("months_before_churn").desc())
    )


def usage_drop_pct(usage: DataFrame, subscriptions: DataFrame, *, months: int = 6) -> DataFrame:
    """Change in mean logins from `months` before the last cancellation to its month."""
    trend = usage_before_churn(usage, subscriptions, months=months)
    ends = trend.agg(
        F.max(F.when(F.col("months_before_churn") == months, F.col("avg_logins"))).alias("first"),
        F.max(F.when(F.col("months_before_churn") == 0, F.col("avg_logins"))).alias("last"),
    )
    drop = F.try_divide(F.col("last") - F.col("first"), F.col("first")) * 100
    return ends.select(
        F.col("first").alias(f"logins_{months}_out"), F.col("last").alias("logins_final"), drop.alias("drop_pct")
    )
