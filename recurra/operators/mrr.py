"""Monthly recurring revenue: per subscription, per customer and month, its movements and its retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions.money import from_cents, rounded_percent, rounded_units, to_cents
from recurra.operators.joins import lookup_join, with_scalar
from recurra.operators.spine import (
    MONTH_START,
    TO_LAST_END,
    TO_SNAPSHOT,
    change_points,
    month_rows,
    spell_months,
    spells,
    with_month_range,
)
from recurra.schemas import PRICE

UNKNOWN = "Unknown"
SEGMENTS = ("plan_tier", "acquisition_channel", "country")


def monthly_value(cycle: Column, monthly_price: Column, annual_price: Column) -> Column:
    """Price per month: a twelfth of the annual price, to the cent, for annual billing."""
    return (
        F.when(cycle == "monthly", monthly_price).when(cycle == "annual", F.round(annual_price / 12, 2)).cast(PRICE)
    )


def price_subscriptions(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Subscriptions with mrr and plan_tier."""
    prices = plans.select("plan_id", "monthly_price", "annual_price", F.col("tier").alias("plan_tier"))
    value = monthly_value(F.col("billing_cycle"), F.col("monthly_price"), F.col("annual_price"))
    priced = lookup_join(subscriptions, prices, "plan_id").withColumn("mrr", value)
    return priced.drop("monthly_price", "annual_price")


def subscription_mrr(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    return price_subscriptions(subscriptions, plans).select(
        "subscription_id", "customer_id", "plan_id", "billing_cycle", "start_date", "end_date", "status", "mrr"
    )


def customer_spells(mrr: DataFrame, *, snapshot: date, horizon: str, by: Sequence[str] = ()) -> DataFrame:
    """customer_id, *by, month, until, cents over subscriptions active at month start; placed by customer."""
    keys = ["customer_id", *by]
    ranged = with_month_range(mrr, convention=MONTH_START, snapshot=snapshot, horizon=horizon)
    points = change_points(ranged.withColumn("cents", to_cents(F.col("mrr"))), keys, with_cents=True)
    return spells(points, keys)


def customer_month_mrr(mrr: DataFrame, *, snapshot: date, horizon: str = TO_LAST_END) -> DataFrame:
    months = spell_months(customer_spells(mrr, snapshot=snapshot, horizon=horizon))
    return months.select("month", "customer_id", from_cents(F.col("cents")).alias("mrr"))


def fact_monthly_subscription(mrr: DataFrame, *, snapshot: date) -> DataFrame:
    months = spell_months(customer_spells(mrr, snapshot=snapshot, horizon=TO_SNAPSHOT, by=["plan_id"]))
    return months.select("month", "customer_id", "plan_id", from_cents(F.col("cents")).alias("mrr"))


def _with_previous(mrr: DataFrame, *, snapshot: date, horizon: str) -> DataFrame:
    # The previous amount is that of the previous active month, which need not be the previous calendar
    # month: only active spells are left here.
    spelled = customer_spells(mrr, snapshot=snapshot, horizon=horizon)
    return spelled.withColumn("prev_cents", F.lag("cents").over(Window.partitionBy("customer_id").orderBy("month")))


def _movement(now: Column, before: Column) -> Column:
    return (
        F.when(before.isNull(), "new").when(now > before, "expansion").when(now < before, "contraction")
        .otherwise("unchanged")
    )


def _delta(now: Column, before: Column) -> Column:
    return now - F.coalesce(before, F.lit(0))


def fact_mrr_waterfall(mrr: DataFrame, *, snapshot: date) -> DataFrame:
    """One row per customer and active month, classified against the customer's previous active month."""
    months = spell_months(_with_previous(mrr, snapshot=snapshot, horizon=TO_SNAPSHOT))
    now, before = F.col("cents"), F.col("before")
    # After its first month a spell repeats its own amount.
    return months.withColumn("before", F.when(F.col("step") == 0, F.col("prev_cents")).otherwise(now)).select(
        "month", "customer_id", from_cents(now).alias("mrr"), from_cents(before).alias("prev_mrr"),
        _movement(now, before).alias("movement_type"), from_cents(_delta(now, before)).alias("mrr_delta"),
    )


def mrr_waterfall(mrr: DataFrame, *, snapshot: date, horizon: str = TO_LAST_END) -> DataFrame:
    """New, expansion, contraction and total MRR by month."""
    spelled = _with_previous(mrr, snapshot=snapshot, horizon=horizon)
    now, before = F.col("cents"), F.col("prev_cents")
    moved = spelled.withColumn("kind", _movement(now, before)).withColumn("delta", _delta(now, before))
    kinds = ("new", "expansion", "contraction")

    def side(month: str, sign: int) -> Column:
        moves = [
            (F.when(F.col("kind") == k, F.col("delta")).otherwise(0) if sign > 0 else F.lit(0)).cast("bigint").alias(k)
            for k in kinds
        ]
        return F.struct(F.col(month).alias("month"), (now * sign).alias("total"), F.lit(sign).alias("customers"), *moves)

    changes = moved.select(F.inline(F.array(side("month", 1), side("until", -1))))
    totals = month_rows(changes, [], running=["total", "customers"], once=kinds).where(F.col("customers") > 0)
    return totals.select("month", *[from_cents(F.col(c)).alias(f"{c}_mrr") for c in (*kinds, "total")])


def monthly_mrr(mrr: DataFrame, *, snapshot: date, horizon: str = TO_LAST_END) -> DataFrame:
    """month, cents over all customers; each task hands on one row per month."""
    ranged = with_month_range(mrr, convention=MONTH_START, snapshot=snapshot, horizon=horizon)
    cents = to_cents(F.col("mrr"))
    up = F.struct(F.col("first_month").alias("month"), cents.alias("cents"), F.lit(1).alias("running"))
    down = F.struct(F.add_months("last_month", 1).alias("month"), (-cents).alias("cents"), F.lit(-1).alias("running"))
    months = month_rows(ranged.select(F.inline(F.array(up, down))), [], running=["cents", "running"])
    return months.where(F.col("running") > 0).drop("running")


def tier_spells(priced: DataFrame, *, snapshot: date) -> DataFrame:
    """customer_id, plan_tier, month, until, cents; a customer's tiers are separate, one tier's spells disjoint."""
    return customer_spells(priced, snapshot=snapshot, horizon=TO_SNAPSHOT, by=["plan_tier"])


def pivot_source(subscriptions: DataFrame, plans: DataFrame, customers: DataFrame, *, snapshot: date) -> DataFrame:
    """MRR and distinct customers by month, plan tier, channel and country (a NULL country is a group)."""
    channel = F.coalesce("acquisition_channel", F.lit(UNKNOWN)).alias("acquisition_channel")
    who = customers.select("customer_id", channel, "country")
    spelled = tier_spells(price_subscriptions(subscriptions, plans), snapshot=snapshot).join(who, "customer_id")

    # A customer is in a cell at most once at a time, so steps of one add up to distinct customers.
    def side(month: str, sign: int) -> Column:
        return F.struct(
            F.col(month).alias("month"), (F.col("cents") * sign).alias("cents"), F.lit(sign).alias("active_customers")
        )

    changes = spelled.select(*SEGMENTS, F.inline(F.array(side("month", 1), side("until", -1))))
    cells = month_rows(changes, SEGMENTS, running=["cents", "active_customers"])
    return cells.where(F.col("active_customers") > 0).select(
        "month", *SEGMENTS, from_cents(F.col("cents")).alias("mrr"), "active_customers"
    )


def mrr_pivot(source: DataFrame, segment: str = "plan_tier", values: Sequence[str] | None = None) -> DataFrame:
    """Months down, segment values across, MRR in the cells.

    Without `values` Spark looks the segment's values up first; with them that extra job is saved.
    """
    pivoted = source.groupBy("month").pivot(segment, list(values) if values else None)
    return pivoted.agg(F.sum("mrr"))


def _retention_cents(mrr: DataFrame, *, snapshot: date) -> DataFrame:
    year_ago = F.add_months(F.lit(snapshot), -12)
    in_base = (F.col("start_date") <= year_ago) & (F.col("end_date").isNull() | (F.col("end_date") >= year_ago))
    cents = to_cents(F.col("mrr"))
    # Both sides of the comparison in one pass and one shuffle; "now" is by status, whatever the start date.
    per_customer = mrr.groupBy("customer_id").agg(
        F.max(in_base).alias("in_base"), F.sum(F.when(in_base, cents)).alias("base"),
        F.sum(F.when(F.col("status") == "active", cents)).alias("now"),
    )
    return per_customer.where("in_base").agg(
        F.sum("base").alias("base"), F.sum(F.coalesce("now", F.lit(0))).alias("now")
    )


def net_revenue_retention(mrr: DataFrame, *, snapshot: date) -> DataFrame:
    """Revenue now of the customers of twelve months ago, against their revenue then."""
    both = _retention_cents(mrr, snapshot=snapshot)
    return both.select(
        from_cents(F.col("base")).alias("starting_mrr_12mo_ago"),
        from_cents(F.col("now")).alias("same_customers_mrr_now"),
        rounded_percent(F.col("now"), F.col("base"), 1).alias("net_revenue_retention_pct"),
    )


def nrr_gap_value(mrr: DataFrame, *, snapshot: date) -> DataFrame:
    """Monthly revenue that retention below 100% costs at the current MRR."""
    current = monthly_mrr(mrr, snapshot=snapshot).agg(F.max_by("cents", "month").alias("cents"))
    retention = net_revenue_retention(mrr, snapshot=snapshot).select("net_revenue_retention_pct")
    per_mille = (F.col("net_revenue_retention_pct") * 10).cast("bigint")
    gap_cents = rounded_units(F.col("cents").cast("decimal(28,0)") * (F.lit(1000) - per_mille), F.lit(1000), 0)
    return with_scalar(current, retention).select(
        from_cents(F.col("cents")).alias("current_mrr"), "net_revenue_retention_pct",
        from_cents(gap_cents).alias("gap_value"),
    )
