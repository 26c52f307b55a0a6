"""The monthly business review."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions.money import from_cents
from recurra.operators.churn import cancellations_by_month
from recurra.operators.mrr import price_subscriptions, tier_spells
from recurra.operators.spine import entries, month_rows

# Fixed value: a monthly logo churn rate above this is red.
CHURN_LIMIT = 0.05


def monthly_summary(subscriptions: DataFrame, plans: DataFrame, customers: DataFrame, *, snapshot: date) -> DataFrame:
    """One row per calendar month between the first and the last month with revenue.

    active_customers adds up the distinct customers of each report cell, so a customer with two plan tiers
    counts twice; active_customers_distinct counts each customer once.
    """
    priced = price_subscriptions(subscriptions, plans)
    on_record = customers.select("customer_id")
    spelled = tier_spells(priced, snapshot=snapshot).join(on_record, "customer_id", "left_semi")

    # Channel and country are the customer's own, so the cells of a customer in a month differ by tier only.
    def side(month: str, sign: int) -> Column:
        return F.struct(F.col(month).alias("month"), (F.col("cents") * sign).alias("cents"), F.lit(sign).alias("running"))

    steps = spelled.select("customer_id", F.inline(F.array(side("month", 1), side("until", -1))))
    points = steps.groupBy("customer_id", "month").agg(F.sum("cents").alias("cents"), F.sum("running").alias("running"))
    changes = entries(points, ["customer_id"]).select(
        "month", "cents", F.col("running").alias("active_customers"), F.col("entered").alias("active_customers_distinct")
    )
    months = month_rows(changes, [], running=["cents", "active_customers", "active_customers_distinct"])
    filled = months.join(cancellations_by_month(priced), "month", "left").fillna(0, ["customers_cancelled"])
    # No key, but one row per calendar month.
    before = F.lag("cents").over(Window.orderBy("month"))
    return filled.withColumn("before", before).select(
        "month", from_cents(F.col("cents")).alias("total_mrr"), "active_customers", "active_customers_distinct",
        "customers_cancelled", F.coalesce("churned_mrr", F.lit(0)).cast("decimal(20,2)").alias("churned_mrr"),
        F.coalesce(F.try_divide("customers_cancelled", "active_customers"), F.lit(0.0)).alias("logo_churn_rate"),
        F.try_divide(F.col("cents") - F.col("before"), F.col("before")).alias("mom_growth_pct"),
    )


def business_review(summary: DataFrame, *, month: date | None = None) -> DataFrame:
    """Key figures of one month (the last by default) with red and green flags; no growth, no flag."""
    figures = ("month", "total_mrr", "active_customers", "logo_churn_rate", "mom_growth_pct")
    if month is None:
        row = summary.agg(F.max_by(F.struct(*figures), "month").alias("row")).where("row is not null").select("row.*")
    else:
        row = summary.where(F.col("month") == F.lit(month)).select(*figures)
    return row.select(
        *figures,
        F.when(F.col("logo_churn_rate") > CHURN_LIMIT, "red").otherwise("green").alias("churn_flag"),
        F.when(F.col("mom_growth_pct") < 0, "red").when(F.col("mom_growth_pct") >= 0, "green").alias("growth_flag"),
    )
