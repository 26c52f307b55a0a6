"""Customer lifetime value, tenure and revenue per customer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.functions.money import from_cents, rounded_ratio, rounded_units, to_cents
from recurra.operators import ranks
from recurra.operators.joins import lookup_join
from recurra.operators.mrr import UNKNOWN

# Fixed value: the average length of a month in days, and the same in hundredths of a day.
DAYS_PER_MONTH = 30.44
_MONTH_IN_HUNDREDTHS = 3044
_MICROS = 1_000_000

SEGMENTS = ("acquisition_channel", "company_size_band", "country", "plan_tier")


def _paid_cents(invoices: DataFrame) -> DataFrame:
    """subscription_id, cents: summed before it meets the subscriptions, so the join is one to one."""
    return (
        invoices.where(F.col("payment_status") == "paid")
        .groupBy("subscription_id")
        .agg(F.sum(to_cents(F.col("amount"))).alias("cents"))
    )


def _rounded_tenure(days: Column) -> Column:
    return rounded_ratio(days * 100, F.lit(_MONTH_IN_HUNDREDTHS), 1)


def _lifetime(subscriptions: DataFrame, invoices: DataFrame, *, snapshot: date, by: list[str]) -> DataFrame:
    """Revenue in cents and tenure per customer, over subscriptions with a paid invoice."""
    paid = subscriptions.join(_paid_cents(invoices), "subscription_id")
    spans = paid.groupBy("customer_id", *by).agg(
        F.sum("cents").alias("cents"), F.min("start_date").alias("first_start"),
        F.max(F.coalesce("end_date", F.lit(snapshot))).alias("last_active"),
    )
    tenure = _rounded_tenure(F.datediff("last_active", "first_start"))
    return spans.withColumn("tenure_months", tenure)


def fact_customer_clv(
    customers: DataFrame, subscriptions: DataFrame, invoices: DataFrame, *, snapshot: date
) -> DataFrame:
    """One row per customer with a paid invoice: revenue and tenure with the customer's segments."""
    lifetime = _lifetime(subscriptions, invoices, snapshot=snapshot, by=[])
    segments = customers.select("customer_id", "country", "company_size_band", "acquisition_channel")
    return segments.join(lifetime, "customer_id").select(
        "customer_id", "country", "company_size_band", "acquisition_channel",
        from_cents(F.col("cents")).alias("total_revenue"), "tenure_months",
    )


def clv_by_segment(
    customers: DataFrame, subscriptions: DataFrame, invoices: DataFrame, plans: DataFrame, *, snapshot: date,
    segment: str,
) -> DataFrame:
    """Customers, average value, average (rounded) tenure and revenue per segment value.

    By plan tier a customer counts once for each tier held.
    """
    if segment not in SEGMENTS:
        raise ValueError(f"expected one of {SEGMENTS}, not {segment!r}")
    if segment == "plan_tier":
        tiers = plans.select("plan_id", F.col("tier").alias("plan_tier"))
        tiered = lookup_join(subscriptions, tiers, "plan_id")
        valued = _lifetime(tiered, invoices, snapshot=snapshot, by=["plan_tier"]).join(
            customers.select("customer_id"), "customer_id"
        )
    else:
        valued = customers.select("customer_id", segment).join(
            _lifetime(subscriptions, invoices, snapshot=snapshot, by=[]), "customer_id"
        )
    tenths = (F.col("tenure_months") * 10).cast("bigint")
    # A NULL segment and a literal 'Unknown' stay two groups with the same label.
    totals = valued.groupBy(segment).agg(
        F.count("*").alias("customers"), F.sum("cents").alias("cents"), F.sum(tenths).alias("tenths")
    )
    n = F.col("customers")
    return totals.select(
        F.coalesce(segment, F.lit(UNKNOWN)).alias(segment), "customers",
        rounded_ratio(F.col("cents"), n * 100, 2).alias("avg_clv"),
        rounded_ratio(F.col("tenths"), n * 10, 1).alias("avg_tenure_months"),
        from_cents(F.col("cents")).alias("total_revenue_from_segment"),
    ).orderBy(F.col("avg_clv").desc())


def _tenure_days(subscriptions: DataFrame, *also: Column, snapshot: date) -> DataFrame:
    spans = subscriptions.groupBy("customer_id").agg(
        F.min("start_date").alias("first_start"), F.max("end_date").alias("last_end"),
        F.coalesce(F.max(F.col("status") == "active"), F.lit(False)).alias("still_active"), *also,
    )
    end = F.when(F.col("still_active"), F.lit(snapshot)).otherwise(F.col("last_end"))
    return spans.withColumn("end_for_tenure", end).withColumn(
        "tenure_days", F.datediff("end_for_tenure", "first_start")
    )


def customer_tenure(subscriptions: DataFrame, *, snapshot: date) -> DataFrame:
    """First start to the snapshot for customers with an active subscription, else to their last end."""
    return _tenure_days(subscriptions, snapshot=snapshot).select(
        "customer_id", "first_start", "last_end", "still_active", "end_for_tenure",
        (F.col("tenure_days") / F.lit(DAYS_PER_MONTH)).alias("tenure_months"),
    )


def tenure_summary(subscriptions: DataFrame, *, snapshot: date) -> DataFrame:
    days = ranks.value_counts(_tenure_days(subscriptions, snapshot=snapshot), "tenure_days")
    both = ranks.median_and_mean(days, ranks.FEW_VALUES)
    return both.select(
        (F.col("median2").cast("double") / 2 / F.lit(DAYS_PER_MONTH)).alias("median"),
        (F.col("total").cast("double") / F.col("n") / F.lit(DAYS_PER_MONTH)).alias("mean"),
    )


def tenure_histogram(subscriptions: DataFrame, *, snapshot: date, bins: int = 30) -> DataFrame:
    days = ranks.value_counts(_tenure_days(subscriptions, snapshot=snapshot), "tenure_days")
    return ranks.equal_width_bins(days, ranks.bounds(days), bins, F.lit(DAYS_PER_MONTH))


def _arpu_micros(subscriptions: DataFrame, invoices: DataFrame, *, snapshot: date) -> DataFrame:
    """Revenue per customer and month of tenure (one month at least), in millionths.

    Whole millionths make every later mean and quantile exact, whatever order rows are added up in.
    """
    revenue = F.sum(F.coalesce("cents", F.lit(0))).alias("cents")
    billed = subscriptions.join(_paid_cents(invoices), "subscription_id", "left")
    spans = _tenure_days(billed, revenue, snapshot=snapshot)
    months = F.greatest(F.col("tenure_days").cast("bigint") * 100, F.lit(_MONTH_IN_HUNDREDTHS))
    per_month = rounded_units(F.col("cents").cast("decimal(28,0)") * _MONTH_IN_HUNDREDTHS, months * 100, 6)
    # No end and no active subscription: no tenure, hence no figure.
    return spans.withColumn("micros", F.when(F.col("tenure_days").isNotNull(), per_month))


def customer_arpu(subscriptions: DataFrame, invoices: DataFrame, *, snapshot: date) -> DataFrame:
    return _arpu_micros(subscriptions, invoices, snapshot=snapshot).select(
        "customer_id", from_cents(F.col("cents")).alias("total_revenue"),
        (F.col("tenure_days") / F.lit(DAYS_PER_MONTH)).alias("tenure_months"),
        (F.col("micros").cast("decimal(18,0)") / F.lit(_MICROS)).cast("decimal(18,6)").alias("arpu"),
    )


def arpu_summary(subscriptions: DataFrame, invoices: DataFrame, *, snapshot: date) -> DataFrame:
    micros = ranks.value_counts(_arpu_micros(subscriptions, invoices, snapshot=snapshot), "micros")
    both = ranks.median_and_mean(micros)
    return both.select(
        (F.col("median2").cast("double") / (2 * _MICROS)).alias("median"),
        (F.col("total").cast("double") / F.col("n") / _MICROS).alias("mean"),
    )


def arpu_histogram(
    subscriptions: DataFrame, invoices: DataFrame, *, snapshot: date, bins: int = 40, cap_percent: int = 99
) -> DataFrame:
    """Equal-width bins over values capped at the exact percentile (linear between neighbours)."""
    micros = ranks.value_counts(_arpu_micros(subscriptions, invoices, snapshot=snapshot), "micros")
    # Hundredths of a millionth: fine enough for the interpolated cap to be whole.
    cap = F.col("low") * 100 + (F.col("high") - F.col("low")) * F.col("hundredths")
    limits = ranks.quantile_neighbours(micros, cap_percent).select(
        cap.alias("cap"), F.least(F.col("lowest") * 100, cap).alias("lowest"),
        F.least(F.col("highest") * 100, cap).alias("highest"),
    )
    capped = F.least(F.col("value") * 100, F.col("cap"))
    return ranks.equal_width_bins(micros, limits, bins, F.lit(100.0 * _MICROS), capped)
