"""Months in which a subscription counts as active, and what follows from them per customer and month.

Two conventions exist and give different numbers, so each caller names one:

* MONTH_START: active in a month if running on its first day.
* OVERLAP: active in every month the subscription touches.

A subscription's months are a range. Instead of being multiplied out, ranges travel as two change points
each (a step up in the first month, a step down after the last). Net changes per customer and month are
summed inside the tasks before they move, so a customer with any number of subscriptions is at most one row
per month afterwards. Running sums over them give spells of unchanged state. Rows per month are made only
where the result has them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions.dates import month_of, months_apart
from recurra.operators.joins import with_scalar

MONTH_START = "month_start"
OVERLAP = "overlap"

# How far open subscriptions run: to the month of the snapshot, or of the latest end on record.
TO_SNAPSHOT = "snapshot"
TO_LAST_END = "last_end"

def _check(value: str, allowed: Sequence[str]) -> None:
    if value not in allowed:
        raise ValueError(f"expected one of {allowed}, not {value!r}")


def _last_month(subscriptions: DataFrame, snapshot: date) -> DataFrame:
    end = F.coalesce(F.col("end_date"), F.lit(snapshot))
    return subscriptions.agg(month_of(F.max(end)).alias("last_month"))


def month_spine(subscriptions: DataFrame, *, snapshot: date, horizon: str = TO_LAST_END) -> DataFrame:
    """Every month from the first start to the horizon."""
    _check(horizon, (TO_SNAPSHOT, TO_LAST_END))
    end = F.coalesce(F.col("end_date"), F.lit(snapshot))
    last = F.max(end) if horizon == TO_LAST_END else F.lit(snapshot)
    bounds = subscriptions.agg(month_of(F.min("start_date")).alias("first_month"), month_of(last).alias("last_month"))
    return explode_months(bounds.where(F.col("first_month") <= F.col("last_month")))


def with_month_range(
    subscriptions: DataFrame, *, convention: str, snapshot: date, horizon: str = TO_SNAPSHOT
) -> DataFrame:
    """Add first_month and last_month; rows active in no month (such as end before start) are gone."""
    _check(convention, (MONTH_START, OVERLAP))
    _check(horizon, (TO_SNAPSHOT, TO_LAST_END))
    start, end = F.col("start_date"), F.col("end_date")
    if convention == OVERLAP:
        ranged = subscriptions.withColumn("first_month", month_of(start)).withColumn(
            "last_month", month_of(F.coalesce(end, F.lit(snapshot)))
        )
    else:
        if horizon == TO_LAST_END:
            bounded = with_scalar(subscriptions, _last_month(subscriptions, snapshot))
        else:
            bounded = subscriptions.withColumn("last_month", F.lit(snapshot.replace(day=1)))
        this_month = month_of(start)
        ranged = bounded.withColumn(
            "first_month", F.when(start == this_month, start).otherwise(F.add_months(this_month, 1))
        ).withColumn("last_month", F.least(F.coalesce(month_of(end), F.col("last_month")), F.col("last_month")))
    return ranged.where(F.col("first_month") <= F.col("last_month"))


def explode_months(ranged: DataFrame) -> DataFrame:
    """One row per month of each range.

    Counting whole offsets and adding them is several times faster than a sequence of dates.
    """
    offsets = F.sequence(F.lit(0), months_apart(F.col("last_month"), F.col("first_month")))
    stepped = ranged.withColumn("_offset", F.explode(offsets))
    month = F.add_months("first_month", F.col("_offset"))
    return stepped.withColumn("month", month).drop("_offset", "first_month", "last_month")


def active_months(subscriptions: DataFrame, *, convention: str, snapshot: date, horizon: str = TO_SNAPSHOT) -> DataFrame:
    """subscription_id, customer_id, month."""
    ranged = with_month_range(subscriptions, convention=convention, snapshot=snapshot, horizon=horizon)
    return explode_months(ranged.select("subscription_id", "customer_id", "first_month", "last_month"))


def active_month_start(subscriptions: DataFrame, *, snapshot: date, horizon: str = TO_LAST_END) -> DataFrame:
    return active_months(subscriptions, convention=MONTH_START, snapshot=snapshot, horizon=horizon)


def active_overlap(subscriptions: DataFrame, *, snapshot: date) -> DataFrame:
    return active_months(subscriptions, convention=OVERLAP, snapshot=snapshot)


def change_points(ranged: DataFrame, keys: Sequence[str], *, with_cents: bool = False) -> DataFrame:
    """Net change per key and month: running subscriptions, and with_cents their cents; placed by customer.

    `priced` counts the subscriptions that have an amount at all.
    """
    sides = F.array(
        F.struct(F.col("first_month").alias("month"), F.lit(1).alias("sign")),
        F.struct(F.add_months("last_month", 1).alias("month"), F.lit(-1).alias("sign")),
    )
    sign, cents = F.col("sign"), F.col("cents")
    net = [F.sum(sign).alias("running")]
    if with_cents:
        net += [F.sum(cents * sign).alias("cents"), F.sum(F.when(cents.isNotNull(), sign)).alias("priced")]
    points = ranged.select(*keys, *(["cents"] if with_cents and "cents" not in keys else []), F.inline(sides))
    return points.groupBy(*keys, "month").agg(*net).repartition("customer_id")


def running_state(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sums so far in place of the changes, and `until`, the month of the next change."""
    in_order = Window.partitionBy(*keys).orderBy("month")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    measures = [c for c in points.columns if c not in (*keys, "month")]
    return points.select(
        *keys, "month", F.lead("month").over(in_order).alias("until"), *[F.sum(c).over(so_far).alias(c) for c in measures]
    )


def spells(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stretches [month, until) of a key in which something runs and nothing changes."""
    active = running_state(points, keys).where(F.col("running") > 0).drop("running")
    if "priced" not in active.columns:
        return active
    return active.withColumn("cents", F.when(F.col("priced") > 0, F.col("cents"))).drop("priced")


def spell_months(spelled: DataFrame) -> DataFrame:
    """One row per month of each spell; `step` is 0 in its first month."""
    steps = F.sequence(F.lit(0), months_apart(F.col("until"), F.col("month")) - 1)
    return (
        spelled.withColumn("step", F.explode(steps)).withColumn("month", F.add_months("month", F.col("step"))).drop("until")
    )


def entries(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add `entered` to change points: 1 where the key becomes active, -1 where it ceases to be."""
    so_far = Window.partitionBy(*keys).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    running = F.sum("running").over(so_far)
    now, before = (running > 0).cast("int"), (running - F.col("running") > 0).cast("int")
    return points.withColumn("entered", now - before)


def month_rows(changes: DataFrame, by: Sequence[str], *, running: Sequence[str], once: Sequence[str] = ()) -> DataFrame:
    """From changes to one row for every month in between: `running` columns add up, `once` columns do not.

    The changes are summed per month (and `by`) before anything else, so the windows here order one row per
    calendar month.
    """
    net = changes.groupBy(*by, "month").agg(*[F.sum(c).alias(c) for c in (*running, *once)])
    in_order = Window.partitionBy(*by).orderBy("month")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    state = net.select(
        *by, "month", F.lead("month").over(in_order).alias("until"),
        *[F.sum(c).over(so_far).alias(c) for c in running], *once,
    )
    # The last change takes everything back to zero; no month follows it.
    months = spell_months(state.where(F.col("until").isNotNull()))
    only_once = {c: F.when(F.col("step") == 0, F.col(c)).otherwise(0) for c in once}
    return months.withColumns(only_once).drop("step") if once else months.drop("step")
