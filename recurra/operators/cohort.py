"""Retention of signup cohorts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions.dates import month_of, months_apart
from recurra.functions.money import rounded_percent, rounded_ratio
from recurra.operators.spine import OVERLAP, change_points, spells, with_month_range

CHECKPOINTS = (0, 1, 3, 6, 12)
YEAR = tuple(range(13))


def cohort_sizes(customers: DataFrame) -> DataFrame:
    return customers.groupBy(month_of(F.col("signup_date")).alias("cohort_month")).agg(
        F.count("*").alias("cohort_size")
    )


def retention(
    customers: DataFrame, subscriptions: DataFrame, *, snapshot: date, offsets: Sequence[int], digits: int = 1
) -> DataFrame:
    """Share of each cohort active (any overlap) the given numbers of months after signup.

    Spells are cut to the months asked for before they become rows. Months before signup are outside.
    """
    cohort_month = month_of(F.col("signup_date")).alias("cohort_month")
    cohorts = customers.select("customer_id", cohort_month).repartition("customer_id").distinct()
    ranged = with_month_range(subscriptions, convention=OVERLAP, snapshot=snapshot)
    spelled = spells(change_points(ranged, ["customer_id"]), ["customer_id"]).join(cohorts, "customer_id")
    first = F.greatest(months_apart(F.col("month"), F.col("cohort_month")), F.lit(min(offsets)))
    last = F.least(months_apart(F.col("until"), F.col("cohort_month")) - 1, F.lit(max(offsets)))
    cut = spelled.select("cohort_month", first.alias("first"), last.alias("last")).where(F.col("first") <= F.col("last"))
    months = cut.select("cohort_month", F.explode(F.sequence("first", "last")).alias("months_since_signup"))
    # A customer's spells do not overlap: one row per customer and month, so a plain count is distinct.
    counts = (
        months.where(F.col("months_since_signup").isin(list(offsets)))
        .groupBy("cohort_month", "months_since_signup")
        .agg(F.count("*").alias("active_customers"))
    )
    return counts.join(cohort_sizes(customers), "cohort_month").select(
        "cohort_month", "cohort_size", "months_since_signup", "active_customers",
        rounded_percent(F.col("active_customers"), F.col("cohort_size"), digits).alias("retention_pct"),
    )


def cohort_retention(customers: DataFrame, subscriptions: DataFrame, *, snapshot: date) -> DataFrame:
    return retention(customers, subscriptions, snapshot=snapshot, offsets=CHECKPOINTS)


def fact_cohort_retention(customers: DataFrame, subscriptions: DataFrame, *, snapshot: date) -> DataFrame:
    return retention(customers, subscriptions, snapshot=snapshot, offsets=YEAR)


def _wide(customers: DataFrame, subscriptions: DataFrame, *, snapshot: date, digits: int) -> DataFrame:
    """One row for each cohort that was ever active, one column for each month since signup."""
    rows = retention(customers, subscriptions, snapshot=snapshot, offsets=YEAR, digits=digits)
    return rows.groupBy("cohort_month").pivot("months_since_signup", list(YEAR)).agg(F.first("retention_pct"))


def _matrix(wide: DataFrame, *, snapshot: date) -> DataFrame:
    """A cell is NULL until its month has come, and 0 if it has come and nobody was active."""
    elapsed = months_apart(F.lit(snapshot), F.col("cohort_month"))
    return wide.select(
        "cohort_month", *[F.when(elapsed >= k, F.coalesce(F.col(str(k)), F.lit(0))).alias(f"m{k}") for k in YEAR]
    )


def cohort_retention_matrix(
    customers: DataFrame, subscriptions: DataFrame, *, snapshot: date, newest: int = 18
) -> DataFrame:
    """Cohorts down, months since signup across; the newest cohorts, as many as a page shows.

    A cohort of which nobody was ever active has a row like the others.
    """
    cohorts = cohort_sizes(customers).where("cohort_month is not null").select("cohort_month")
    wide = _wide(customers, subscriptions, snapshot=snapshot, digits=1)
    matrix = _matrix(cohorts.join(wide, "cohort_month", "left"), snapshot=snapshot)
    return matrix.orderBy(F.col("cohort_month").desc()).limit(newest)


def cohort_m12_summary(customers: DataFrame, subscriptions: DataFrame, *, snapshot: date) -> DataFrame:
    """Lowest, highest and mean twelve-month retention over the cohorts that were ever active and are old enough to have one."""
    matrix = _matrix(_wide(customers, subscriptions, snapshot=snapshot, digits=6), snapshot=snapshot)
    year = F.col("m12")
    return matrix.agg(
        F.min(year).alias("min_pct"), F.max(year).alias("max_pct"),
        rounded_ratio(F.sum(year) * 1_000_000, F.count(year) * 1_000_000, 4).alias("mean_pct"), F.count(year).alias("n_cohorts"),
    )
