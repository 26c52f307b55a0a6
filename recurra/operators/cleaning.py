"""Cleaning: raw tables of messy text to typed tables, duplicates merged, odd invoices flagged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.functions.dates import first_of_month, is_ambiguous_date, iso_date, messy_date
from recurra.functions.money import is_formatted_amount, parse_amount, rounded_percent
from recurra.functions.text import canonical_country, comparable_name
from recurra.operators.invoices import priced_subscriptions
from recurra.operators.joins import spread_join, with_scalar
from recurra.schemas import MALFORMED, PRICE, PRIMARY_KEYS
from recurra.session import cut_lineage

# An amount above 5 times or below 0.2 times the list price is an outlier.
_TOO_HIGH, _TOO_LOW = "5.0", "0.2"


def clean_country(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", canonical_country(F.col("country")).alias("country"))


def parse_messy_date(customers: DataFrame, column: str = "signup_date") -> DataFrame:
    raw = F.col(column)
    return customers.select(
        "customer_id", messy_date(raw).alias(column), is_ambiguous_date(raw).alias(f"{column}_ambiguous")
    )


def normalize_name(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", comparable_name(F.col("company_name")).alias("norm_name"))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, counted and in percent, in one pass."""
    counts = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot("n", list(columns), "column_name", "n_missing").select(
        "column_name", "n_missing", rounded_percent(F.col("n_missing"), F.col("n"), 1).alias("pct_missing")
    )


def customer_remap(customers: DataFrame) -> DataFrame:
    """duplicate_customer_id, canonical_customer_id for customers of one name; the lowest id stays.

    Names are reduced to (lowest id, count) before they move. Only names held more than once come back to
    the customers, and a name that very many rows share is spread over tasks there.
    """
    named = normalize_name(customers).where(F.col("norm_name").isNotNull())
    shared = (
        named.groupBy("norm_name")
        .agg(F.min("customer_id").alias("canonical_customer_id"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .drop("n")
    )
    return (
        spread_join(named, shared, "norm_name", ["customer_id"], "inner")
        .where(F.col("customer_id") != F.col("canonical_customer_id"))
        .select(F.col("customer_id").alias("duplicate_customer_id"), "canonical_customer_id")
    )


def clean_customers(customers: DataFrame, remap: DataFrame) -> DataFrame:
    duplicates = remap.select(F.col("duplicate_customer_id").alias("customer_id"))
    raw_date = F.col("signup_date")
    return customers.join(duplicates, "customer_id", "left_anti").select(
        "customer_id", "company_name", canonical_country(F.col("country")).alias("country"), "company_size_band",
        messy_date(raw_date).alias("signup_date"), "acquisition_channel",
        is_ambiguous_date(raw_date).alias("signup_date_ambiguous"),
    )


def remap_customer_id(df: DataFrame, remap: DataFrame, spread_by: Sequence[str]) -> DataFrame:
    """customer_id replaced by the canonical one; `spread_by` tells the rows of one customer apart."""
    renamed = remap.withColumnRenamed("duplicate_customer_id", "customer_id")
    joined = spread_join(df, renamed, "customer_id", spread_by, "left")
    return joined.withColumn("customer_id", F.coalesce("canonical_customer_id", "customer_id")).select(df.columns)


def clean_subscriptions(subscriptions: DataFrame, remap: DataFrame) -> DataFrame:
    typed = subscriptions.withColumn("start_date", messy_date(F.col("start_date"))).withColumn(
        "end_date", iso_date(F.col("end_date"))
    )
    return remap_customer_id(typed, remap, PRIMARY_KEYS["subscriptions"])


def clean_amount(invoices: DataFrame) -> DataFrame:
    raw = F.col("amount")
    return invoices.select(
        "invoice_id", "subscription_id", parse_amount(raw).alias("amount"),
        is_formatted_amount(raw).alias("was_formatted"),
    )


def _with_outlier_flag(invoices: DataFrame, subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Add expected_price (whole annual price for annual billing) and is_outlier (false where unknown)."""
    prices = priced_subscriptions(subscriptions, plans, how="left")
    # Any cycle but monthly is compared with the annual price.
    expected = F.when(F.col("billing_cycle") == "monthly", F.col("monthly_price")).otherwise(F.col("annual_price"))
    amount, price = F.col("amount"), F.col("expected_price")

    def times(factor: str) -> Column:
        return price * F.lit(factor).cast("decimal(2,1)")

    odd = (amount > times(_TOO_HIGH)) | (amount < times(_TOO_LOW))
    return (
        invoices.join(prices, "subscription_id", "left")
        .withColumn("expected_price", expected)
        .withColumn("is_outlier", F.coalesce(odd, F.lit(False)))
        .drop("billing_cycle", "monthly_price", "annual_price")
    )


def flag_invoice_outliers(invoices: DataFrame, subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    return _with_outlier_flag(invoices, subscriptions, plans).select(
        "invoice_id", "subscription_id", "amount", "expected_price", "is_outlier"
    )


def typed_invoices(invoices: DataFrame, subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """The clean columns beside was_formatted, expected_price and whatever else `invoices` has."""
    typed = invoices.withColumns({
        "was_formatted": is_formatted_amount(F.col("amount")), "invoice_date": messy_date(F.col("invoice_date")), "amount": parse_amount(F.col("amount")),
    })
    return _with_outlier_flag(typed, subscriptions, plans)


def clean_invoices(invoices: DataFrame, subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    return typed_invoices(invoices, subscriptions, plans).select(
        "invoice_id", "subscription_id", "invoice_date", "amount", "payment_status", "is_outlier"
    )


def clean_usage(usage: DataFrame, remap: DataFrame, *also: Column) -> DataFrame:
    """Rows of merged customers meet in the same month, so counts are summed; `also` are further aggregates of the rows."""
    others = [c for c in usage.columns if c not in ("customer_id", "month", "login_count", "feature_usage_count")]
    month = first_of_month(F.col("month")).alias("usage_month")
    typed = usage.select("customer_id", month, "login_count", "feature_usage_count", *others)
    merged = remap_customer_id(typed, remap, ["usage_month", "login_count", "feature_usage_count"])
    return merged.groupBy("customer_id", "usage_month").agg(
        F.sum("login_count").alias("login_count"), F.sum("feature_usage_count").alias("feature_usage_count"), *also
    )


def clean_tickets(tickets: DataFrame, remap: DataFrame) -> DataFrame:
    typed = tickets.withColumn("created_date", iso_date(F.col("created_date"))).withColumn(
        "resolved_date", iso_date(F.col("resolved_date"))
    )
    return remap_customer_id(typed, remap, PRIMARY_KEYS["support_tickets"])


def clean_plans(plans: DataFrame, keep_malformed: bool = False) -> DataFrame:
    return plans.select(
        "plan_id", "plan_name", "tier", F.col("monthly_price").cast(PRICE).alias("monthly_price"),
        F.col("annual_price").cast(PRICE).alias("annual_price"), *([MALFORMED] if keep_malformed else []),
    )


def clean_tables(raw: Mapping[str, DataFrame], remap: DataFrame | None = None) -> dict[str, DataFrame]:
    """All six clean tables; four of them need the duplicate map, which is computed and written once."""
    remap = cut_lineage(customer_remap(raw["customers"])) if remap is None else remap
    subscriptions = clean_subscriptions(raw["subscriptions"], remap)
    plans = clean_plans(raw["plans"])
    return {
        "customers": clean_customers(raw["customers"], remap),
        "plans": plans,
        "subscriptions": subscriptions,
        "invoices": clean_invoices(raw["invoices"], raw["subscriptions"], plans),
        "usage_monthly": clean_usage(raw["usage_monthly"], remap),
        "support_tickets": clean_tickets(raw["support_tickets"], remap),
    }


def _long(row: DataFrame, table: str) -> DataFrame:
    """One row of counts to (table_name, metric, value)."""
    counts = row.select(*[F.col(c).cast("bigint").alias(c) for c in row.columns])
    return counts.unpivot([], counts.columns, "metric", "value").select(
        F.lit(table).alias("table_name"), "metric", F.coalesce("value", F.lit(0)).alias("value")
    )


def _customer_log(customers: DataFrame, remap: DataFrame) -> list[DataFrame]:
    """Every merged duplicate is one row less, so what is left needs no pass of its own."""
    spelling, signup = F.col("country"), F.col("signup_date")
    # Spellings are few, so they are grouped first; both distinct counts then read a handful of rows.
    by_spelling = customers.groupBy("country").agg(
        F.count("*").alias("n"), F.count_if(is_ambiguous_date(signup)).alias("ambiguous"),
        F.count_if(messy_date(signup).isNull()).alias("failed"),
        F.count_if(F.col("company_size_band").isNull()).alias("no_band"),
        F.count_if(F.col("acquisition_channel").isNull()).alias("no_channel"),
    )
    known = canonical_country(spelling)
    totals = by_spelling.agg(
        F.sum("n").alias("rows_in"), F.count(spelling).alias("raw_countries"),
        F.countDistinct(known).alias("canonical_countries"),
        F.sum(F.when(known.isNull(), F.col("n"))).alias("unmapped_countries"),
        F.sum("ambiguous").alias("ambiguous_dates"), F.sum("failed").alias("failed_dates"),
        F.sum("no_band").alias("missing_company_size_band"),
        F.sum("no_channel").alias("missing_acquisition_channel"),
    )
    both = with_scalar(totals, remap.agg(F.count("*").alias("merged_duplicates")))
    return [_long(both.withColumn("rows_out", F.col("rows_in") - F.col("merged_duplicates")), "customers")]


def _usage_log(usage: DataFrame, remap: DataFrame) -> DataFrame:
    """Rows in and out in one pass: a row out is a group of rows in."""
    named = usage.select("customer_id", first_of_month(F.col("month")).alias("usage_month"), "login_count", "feature_usage_count")
    merged = remap_customer_id(named, remap, ["usage_month", "login_count", "feature_usage_count"])
    groups = merged.groupBy("customer_id", "usage_month").agg(F.count("*").alias("n"))
    return groups.agg(F.sum("n").alias("rows_in"), F.count("*").alias("rows_out"))


def malformed_rows(raw: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Rows that a reader could not make sense of, for the tables that say so (read_raw with keep_malformed)."""
    return [
        _long(df.agg(F.count_if(MALFORMED).alias("malformed_rows")), name) for name, df in raw.items() if MALFORMED in df.columns
    ]


def cleaning_log(raw: Mapping[str, DataFrame]) -> DataFrame:
    """What cleaning met and did, as (table_name, metric, value); one aggregate per table."""
    remap = cut_lineage(customer_remap(raw["customers"]))
    start, day, amount = F.col("start_date"), F.col("invoice_date"), F.col("amount")
    rows_in, rows_out = F.count("*").alias("rows_in"), F.count("*").alias("rows_out")
    flagged = _with_outlier_flag(
        raw["invoices"].select(
            "subscription_id", messy_date(day).alias("invoice_date"), parse_amount(amount).alias("amount"),
            is_formatted_amount(amount).alias("was_formatted"),
        ),
        raw["subscriptions"], clean_plans(raw["plans"]),
    )
    # Subscriptions, invoices, tickets and plans keep every row.
    parts = [
        *_customer_log(raw["customers"], remap),
        _long(raw["plans"].agg(rows_in, rows_out), "plans"),
        _long(
            raw["subscriptions"].agg(
                rows_in, rows_out, F.count_if(is_ambiguous_date(start)).alias("ambiguous_dates"),
                F.count_if(messy_date(start).isNull()).alias("failed_dates"),
            ),
            "subscriptions",
        ),
        _long(
            flagged.agg(
                rows_in, rows_out, F.count_if("was_formatted").alias("formatted_amounts"),
                F.count_if(F.col("amount").isNull()).alias("failed_amounts"),
                F.count_if("is_outlier").alias("outliers"),
                F.count_if(F.col("invoice_date").isNull()).alias("failed_dates"),
            ),
            "invoices",
        ),
        _long(_usage_log(raw["usage_monthly"], remap), "usage_monthly"),
        _long(raw["support_tickets"].agg(rows_in, rows_out), "support_tickets"),
        *malformed_rows(raw),
    ]
    return reduce(DataFrame.unionByName, parts)
