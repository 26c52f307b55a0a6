"""Churn, by cancelled subscription and by customers who disappear."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions.dates import month_of
from recurra.functions.money import from_cents, rounded_percent, to_cents
from recurra.operators.spine import (
    MONTH_START,
    OVERLAP,
    change_points,
    entries,
    month_rows,
    spells,
    with_month_range,
)


def active_customers_by_month(subscriptions: DataFrame, *, snapshot: date) -> DataFrame:
    ranged = with_month_range(subscriptions, convention=OVERLAP, snapshot=snapshot)
    entered = entries(change_points(ranged, ["customer_id"]), ["customer_id"])
    months = month_rows(entered.select("month", F.col("entered").alias("active_customers")), [], running=["active_customers"])
    return months.where(F.col("active_customers") > 0)


def cancellations(mrr: DataFrame) -> DataFrame:
    """Cancelled subscriptions with the month they ended in."""
    return mrr.where(F.col("status") == "cancelled").select(
        month_of(F.col("end_date")).alias("churn_month"), "customer_id", F.col("mrr").alias("churned_mrr")
    )


def cancellations_by_month(mrr: DataFrame) -> DataFrame:
    ended = cancellations(mrr).where(F.col("churn_month").isNotNull())
    # Per customer first: a month in which one customer cancels a great many stays spread over tasks.
    per_customer = ended.groupBy("churn_month", "customer_id").agg(F.sum(to_cents(F.col("churned_mrr"))).alias("cents"))
    return (
        per_customer.groupBy(F.col("churn_month").alias("month"))
        .agg(F.count("customer_id").alias("customers_cancelled"), F.sum("cents").alias("cents"))
        .select("month", "customers_cancelled", from_cents(F.col("cents")).alias("churned_mrr"))
    )


def monthly_churn(mrr: DataFrame, *, snapshot: date) -> DataFrame:
    """Customers with a cancelled subscription in a month, against the customers active in it."""
    active = active_customers_by_month(mrr, snapshot=snapshot)
    lost = cancellations_by_month(mrr)
    churned = F.coalesce("customers_cancelled", F.lit(0)).cast("bigint")
    return active.join(lost, "month", "left").select(
        "month", "active_customers", churned.alias("customers_churned"),
        rounded_percent(churned, F.col("active_customers"), 2).alias("logo_churn_rate_pct"),
        F.coalesce("churned_mrr", F.lit(0)).cast("decimal(20,2)").alias("churned_mrr"),
    )


def fact_churn_by_month(mrr: DataFrame, *, snapshot: date) -> DataFrame:
    """Customers active at one month's start and not at the next one's.

    Equal amounts of a customer in a month count once in churned_mrr. The month of the snapshot is left
    out: nobody can be seen to leave it.
    """
    amounts = mrr.withColumn("cents", to_cents(F.col("mrr")))
    ranged = with_month_range(amounts, convention=MONTH_START, snapshot=snapshot)
    keys = ["customer_id", "cents"]
    held = spells(change_points(ranged, keys), keys)

    def amount_side(month: str, sign: int) -> Column:
        return F.struct(
            F.col(month).alias("month"), (F.col("cents") * sign).alias("delta"), F.lit(sign).alias("running")
        )

    # From spells of an amount to spells of the customer; both are local to the customer's task.
    steps = held.select("customer_id", F.inline(F.array(amount_side("month", 1), amount_side("until", -1))))
    net = steps.groupBy("customer_id", "month").agg(F.sum("running").alias("running"), F.sum("delta").alias("cents"))
    spelled = spells(net, ["customer_id"])
    following = F.lead("month").over(Window.partitionBy("customer_id").orderBy("month"))
    gone = F.coalesce(following != F.col("until"), F.lit(True)).cast("int")

    def side(month: Column, active: int, churned: Column) -> Column:
        return F.struct(
            month.alias("month"), F.lit(active).alias("active_customers"), churned.alias("customers_churned"),
            (churned * F.coalesce("cents", F.lit(0))).alias("cents"),
        )

    first, until, nobody = F.col("month"), F.col("until"), F.lit(0)
    changes = spelled.withColumn("gone", gone).select(
        F.inline(F.array(side(first, 1, nobody), side(until, -1, nobody), side(F.add_months(until, -1), 0, F.col("gone"))))
    )
    totals = month_rows(
        changes, [], running=["active_customers"], once=["customers_churned", "cents"]
    ).where((F.col("active_customers") > 0) & (F.col("month") < F.lit(snapshot.replace(day=1))))
    return totals.select(
        "month", "active_customers", "customers_churned", from_cents(F.col("cents")).alias("churned_mrr"),
        rounded_percent(F.col("customers_churned"), F.col("active_customers"), 2).alias("logo_churn_rate_pct"),
    )
