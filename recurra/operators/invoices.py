"""Invoices against the list price."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.functions.money import rounded_percent
from recurra.operators.joins import lookup_join

PER_MONTH = "per_month"
PER_YEAR = "per_year"


def priced_subscriptions(subscriptions: DataFrame, plans: DataFrame, *, how: str = "inner") -> DataFrame:
    """subscription_id, billing_cycle, monthly_price, annual_price: the narrow side of the invoice joins."""
    prices = plans.select("plan_id", "monthly_price", "annual_price")
    narrow = subscriptions.select("subscription_id", "plan_id", "billing_cycle")
    return lookup_join(narrow, prices, "plan_id", how).drop("plan_id")


def invoice_price_check(
    invoices: DataFrame, subscriptions: DataFrame, plans: DataFrame, *, annual_basis: str = PER_MONTH
) -> DataFrame:
    """Invoice amounts beside the expected price; invoices of unknown subscriptions are left out.

    With PER_MONTH an annual subscription is expected at a twelfth of its annual price, unrounded; the
    outlier flag, by contrast, was set against the whole annual price.
    """
    if annual_basis not in (PER_MONTH, PER_YEAR):
        raise ValueError(f"expected {PER_MONTH!r} or {PER_YEAR!r}, not {annual_basis!r}")
    annual = F.col("annual_price").cast("double") / (12 if annual_basis == PER_MONTH else 1)
    expected = F.when(F.col("billing_cycle") == "monthly", F.col("monthly_price").cast("double")).otherwise(annual)
    return invoices.join(priced_subscriptions(subscriptions, plans), "subscription_id").select(
        "invoice_id", expected.alias("expected_price"), "amount", "is_outlier"
    )


def outlier_share(checked: DataFrame) -> DataFrame:
    counts = checked.agg(F.count_if("is_outlier").alias("n_outliers"), F.count("*").alias("n_invoices"))
    return counts.select(
        "n_outliers", "n_invoices", rounded_percent(F.col("n_outliers"), F.col("n_invoices"), 1).alias("outlier_pct")
    )


def invoice_sample(checked: DataFrame, columns: Sequence[str], *, n: int = 3000, seed: int = 1) -> DataFrame:
    """A repeatable sample of n rows: the lowest hashes of the row's columns and the seed.

    The order does not depend on partitioning, and each task hands on its lowest n rows at most.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    mark = F.md5(F.concat_ws("|", F.lit(str(seed)), *text))
    return checked.select(*columns, mark.alias("_mark")).orderBy("_mark").limit(n).drop("_mark")
