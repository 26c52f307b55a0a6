"""The registered queries: each reads the whole test tables in a folder and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, StructField

from recurra.operators import (
    churn,
    cleaning,
    cohort,
    compare,
    intervals,
    invoices,
    mrr,
    quality,
    report,
    sketches,
    spine,
    star,
    usage,
    value,
)
from recurra.schemas import CLEAN
from recurra.session import cut_lineage, shared_dir
from recurra.sources import jobs, publishing
from recurra.sources import tables as io
from recurra.sources.derived import SNAPSHOT, DerivedTables
from recurra.sources.files import removed

Query = Callable[[SparkSession, str], DataFrame]

TIERS = ("Starter", "Professional", "Enterprise")
PROFILED = ("company_name", "country", "company_size_band", "signup_date", "acquisition_channel")
SAMPLED = ("invoice_id", "expected_price_cents", "amount", "is_outlier")


def _mrr(t: DerivedTables) -> DataFrame:
    return mrr.subscription_mrr(t["subscriptions"], t["plans"])


def _remap(t: DerivedTables) -> DataFrame:
    return cleaning.customer_remap(t["raw_customers"])


def _price_check(t: DerivedTables) -> DataFrame:
    return invoices.invoice_price_check(t["invoices"], t["subscriptions"], t["plans"])


def _clean(t: DerivedTables) -> dict[str, DataFrame]:
    return cleaning.clean_tables(t.raw())


def _reconcile_churn(t: DerivedTables) -> DataFrame:
    priced = _mrr(t)
    return quality.reconcile(
        churn.monthly_churn(priced, snapshot=SNAPSHOT), churn.fact_churn_by_month(priced, snapshot=SNAPSHOT),
        ["month"], ["active_customers", "customers_churned", "churned_mrr"],
    )


def _sample(t: DerivedTables) -> DataFrame:
    cents = F.round(F.col("expected_price") * 100).cast("bigint")
    return invoices.invoice_sample(_price_check(t).withColumn("expected_price_cents", cents), SAMPLED)


def _metrics(t: DerivedTables) -> DataFrame:
    profile = cleaning.null_profile(t["customers"], ["company_size_band", "acquisition_channel"])
    missing = profile.groupBy().pivot("column_name", ["company_size_band", "acquisition_channel"])
    return io.metrics_table(
        [
            ("missing_pct", missing.agg(F.first("pct_missing"))),
            ("tenure_months", value.tenure_summary(t["subscriptions"], snapshot=SNAPSHOT)),
            ("arpu", value.arpu_summary(t["subscriptions"], t["invoices"], snapshot=SNAPSHOT)),
            ("retention_m12", cohort.cohort_m12_summary(t["customers"], t["subscriptions"], snapshot=SNAPSHOT)),
            ("usage_before_churn", usage.usage_drop_pct(t["usage_monthly"], t["subscriptions"])),
            ("outliers", invoices.outlier_share(_price_check(t))),
        ],
        cleaning.cleaning_log(t.raw()),
    )


def _clv(t: DerivedTables, segment: str) -> DataFrame:
    return value.clv_by_segment(
        t["customers"], t["subscriptions"], t["invoices"], t["plans"], snapshot=SNAPSHOT, segment=segment
    )


def _summary(t: DerivedTables) -> DataFrame:
    return report.monthly_summary(t["subscriptions"], t["plans"], t["customers"], snapshot=SNAPSHOT)


def _pivot_source(t: DerivedTables) -> DataFrame:
    return mrr.pivot_source(t["subscriptions"], t["plans"], t["customers"], snapshot=SNAPSHOT)


def _whole(f: StructField) -> Column:
    """A column as a text that two engines write alike: decimals and doubles, which have two places at most, as whole hundredths."""
    value = F.col(f.name)
    if isinstance(f.dataType, (DecimalType, DoubleType)):
        value = F.round(value * 100).cast("bigint")
    return F.coalesce(value.cast("string"), F.lit("~"))


def _stored_cells(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, filled cells and a digest of all values of each table that does not depend on the order of rows."""
    parts = []
    for name, df in tables.items():
        filled = reduce(Column.__add__, [F.count(c) for c in df.columns])
        digest = F.conv(F.substring(F.md5(F.concat_ws("|", *map(_whole, df.schema.fields))), 1, 8), 16, 10).cast("bigint")
        parts.append(
            df.agg(F.count("*").alias("n_rows"), filled.alias("n_values"), F.sum(digest).alias("digest")).select(
                F.lit(name).alias("table_name"), "n_rows", "n_values", "digest"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _round_trip(t: DerivedTables, purpose: str, write: Callable[[str], None], read: Callable[[str], DataFrame]) -> DataFrame:
    """What `read` finds in a new folder after `write`; the folder goes as soon as the result, a few rows, is kept."""
    folder = f"{shared_dir(t.spark)}/recurra-{purpose}-{uuid.uuid4().hex}"
    write(folder)
    found = cut_lineage(read(folder))
    removed(t.spark, folder)
    return found


def _read_raw(t: DerivedTables) -> DataFrame:
    def write(folder: str) -> None:
        for name, df in t.raw().items():
            # The columns in another order than read_raw returns them.
            df.select(*reversed(df.columns)).write.options(**io.CSV_OUT, compression="gzip").csv(f"{folder}/{name}")

    return _round_trip(t, "raw", write, lambda folder: _stored_cells(io.read_raw(t.spark, folder)))


def _write_clean(t: DerivedTables) -> DataFrame:
    return _round_trip(
        t, "clean", lambda folder: io.write_clean(_clean(t), folder), lambda folder: _stored_cells(io.read_clean(t.spark, folder))
    )


def _read_clean(t: DerivedTables) -> DataFrame:
    return _round_trip(
        t, "typed", lambda folder: io.write_clean(t.clean(), folder, "csv"),
        lambda folder: _stored_cells(io.read_clean(t.spark, folder, "csv")),
    )


def _publish_star(t: DerivedTables) -> DataFrame:
    tables = star.star_tables(t.clean(), snapshot=SNAPSHOT)
    return _round_trip(
        t, "star", lambda folder: io.publish_star(tables, folder),
        lambda folder: _stored_cells({n: t.spark.read.parquet(f"{folder}/{n}").select(df.columns) for n, df in tables.items()}),
    )


def _whole_set(t: DerivedTables) -> dict[str, DataFrame]:
    """The clean tables with invoice ids that are unique: the test tables repeat some, which publishing refuses, so the place of a row
    among those of its id is added to it."""
    tables = t.clean()
    others = [c for c in tables["invoices"].columns if c != "invoice_id"]
    nth = F.row_number().over(Window.partitionBy("invoice_id").orderBy(*others))
    return tables | {"invoices": tables["invoices"].withColumn("invoice_id", F.col("invoice_id") * 100_000 + nth).select(tables["invoices"].columns)}


def _publish_tables(t: DerivedTables) -> DataFrame:
    """Into a database of its own, read back from the catalog, and gone once the result is kept."""
    database = f"recurra_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database}")
    try:
        io.publish_tables(_whole_set(t), database, buckets=4)
        return cut_lineage(_stored_cells({name: t.spark.table(f"{database}.{name}") for name in CLEAN}))
    finally:
        t.spark.sql(f"DROP DATABASE {database} CASCADE")


def _publish_run(t: DerivedTables) -> DataFrame:
    """As a run that readers are switched to, and read back through the pointer."""
    return _round_trip(
        t, "run", lambda folder: publishing.publish_run(_whole_set(t), folder, run="first"),
        lambda folder: _stored_cells(publishing.read_published(t.spark, folder)),
    )


def _run_cleaning(t: DerivedTables) -> DataFrame:
    """The log that a cleaning run over CSV files brings along."""
    logs = []

    def write(folder: str) -> None:
        for name, df in t.raw().items():
            df.write.options(**io.CSV_OUT).csv(f"{folder}/raw/{name}")
        logs.append(jobs.run_cleaning(t.spark, f"{folder}/raw", f"{folder}/clean").log)

    return _round_trip(t, "cleaning", write, lambda folder: logs[0])


def _fact_of(t: DerivedTables) -> DataFrame:
    return mrr.fact_monthly_subscription(_mrr(t), snapshot=SNAPSHOT)


def _refresh_by_month(t: DerivedTables) -> DataFrame:
    """The fact is loaded without the customers of plan 2 in even months, then whole: what happens to each month, and what is stored after."""
    found = []

    def write(folder: str) -> None:
        fact = cut_lineage(_fact_of(t))
        publishing.refresh_by_month(fact.where("plan_id <> 2 OR month(month) % 2 = 1"), folder)
        done = publishing.refresh_by_month(fact, folder)
        stored = t.spark.read.schema(fact.schema).parquet(f"{folder}/data")
        cents = F.sum((F.col("mrr") * 100).cast("bigint"))
        found.append(stored.groupBy("month").agg(cents.alias("cents")).join(done, "month").select("month", "status", "n_rows", "cents"))

    return _round_trip(t, "months", write, lambda folder: found[0])


def _compare_tables(t: DerivedTables) -> DataFrame:
    """Invoices against invoices of which some are missing, changed or new, by id: the ids that the tables disagree on."""
    left = cut_lineage(_whole_set(t)["invoices"].select("invoice_id", "subscription_id", "amount", "payment_status"))
    changed = F.when(F.col("invoice_id") % 997 == 101, F.col("amount") + 1).otherwise(F.col("amount"))
    status = F.when(F.col("invoice_id") % 1999 == 201, None).otherwise(F.col("payment_status"))
    right = left.where("invoice_id % 2999 <> 301").withColumns({"amount": changed, "payment_status": status})
    added = left.where("invoice_id % 2003 = 401").withColumn("invoice_id", -F.col("invoice_id"))
    return compare.differing_rows(left, cut_lineage(right.union(added)), ["invoice_id"])


def _overlapping_tickets(t: DerivedTables) -> DataFrame:
    """Tickets against weeks, by a join of the intervals: open tickets and the days they were open, by week."""
    weeks = t.spark.sql("SELECT monday, date_add(monday, 6) AS sunday FROM (SELECT explode(sequence(DATE '1992-01-06', DATE '2030-12-30', INTERVAL 7 DAYS)) AS monday)")
    tickets = t["support_tickets"].select("ticket_id", "created_date", F.coalesce("resolved_date", F.lit(SNAPSHOT)).alias("closed_date"))
    pairs = intervals.overlap_join(tickets, weeks, left_range=("created_date", "closed_date"), right_range=("monday", "sunday"))
    days = F.datediff(F.least("left.closed_date", "right.sunday"), F.greatest("left.created_date", "right.monday")) + 1
    return pairs.groupBy(F.col("right.monday").alias("week")).agg(F.count("*").alias("open_tickets"), F.sum(days).alias("open_days"))


def _active_by_overlap(t: DerivedTables) -> DataFrame:
    """Months against the subscriptions that run in them, by a join of the intervals: active customers by month and tier."""
    months = spine.month_spine(t["subscriptions"], snapshot=SNAPSHOT).select("month", F.last_day("month").alias("month_end"))
    held = t["subscriptions"].select("customer_id", "plan_id", "start_date", F.coalesce("end_date", F.lit(SNAPSHOT)).alias("last_day"))
    pairs = intervals.overlap_join(held, months, left_range=("start_date", "last_day"), right_range=("month", "month_end"))
    return pairs.groupBy("right.month", "left.plan_id").agg(F.countDistinct("left.customer_id").alias("active_customers"), F.count("*").alias("subscriptions"))


def _sketched_customers(t: DerivedTables) -> DataFrame:
    """Distinct customers by year from sketches by month, and whether each is within four standard errors of the exact count."""
    rows = t["usage_monthly"].select("usage_month", "customer_id")
    year = F.year("usage_month").alias("year")
    stored = sketches.distinct_sketches(rows, ["usage_month"], "customer_id")
    merged = sketches.distinct_counts(sketches.merged_distinct(stored.select(year, "sketch"), ["year"]))
    exact = rows.groupBy(year).agg(F.countDistinct("customer_id").alias("customers"))
    near = F.abs(F.col("approx_count") - F.col("customers")) <= 4 * sketches.distinct_error() * F.col("customers")
    return merged.join(exact, "year").select("year", "customers", near.alias("within_bound"))


def _sketched_amounts(t: DerivedTables) -> DataFrame:
    """Quartiles of invoice amounts by status from sketches by month, and whether each has the rank asked for within 3 %."""
    cents = (F.col("amount") * 100).cast("bigint").alias("cents")
    rows = t["invoices"].where("amount IS NOT NULL").select("payment_status", F.trunc("invoice_date", "month").alias("month"), cents)
    stored = sketches.quantile_sketches(rows, ["payment_status", "month"], "cents")
    found = sketches.quantiles(sketches.merged_quantiles(stored, ["payment_status"]), (0.25, 0.5, 0.75))
    counted = rows.groupBy("payment_status", "cents").agg(F.count("*").alias("copies"))
    # As many rows as statuses and shares.
    judged = counted.join(F.broadcast(found), "payment_status").groupBy("payment_status", "share").agg(
        F.sum("copies").alias("n"), F.sum(F.when(F.col("cents") < F.col("value"), F.col("copies")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("cents") <= F.col("value"), F.col("copies")).otherwise(0)).alias("through"),
    )
    near = (F.col("below") <= (F.col("share") + 0.03) * F.col("n")) & (F.col("through") >= (F.col("share") - 0.03) * F.col("n"))
    return judged.select("payment_status", "share", "n", near.alias("within_bound"))


def _view(t: DerivedTables) -> DataFrame:
    io.register_views({"subscriptions": t["subscriptions"], "plans": t["plans"]}, prefix="recurra_")
    return t.spark.sql("SELECT * FROM recurra_subscription_mrr")


def _reconcile_mrr(t: DerivedTables) -> DataFrame:
    """The waterfall's total against the report's MRR, by month."""
    return quality.reconcile(mrr.mrr_waterfall(_mrr(t), snapshot=SNAPSHOT), _summary(t), ["month"], ["total_mrr"])


def _reconcile_metrics(t: DerivedTables) -> DataFrame:
    """Counts of the clean tables against those of the cleaning log, by table."""
    counted = quality.table_row_counts(_clean(t)).select("table_name", F.col("n_rows").alias("rows_out"))
    logged = cleaning.cleaning_log(t.raw()).where("metric = 'rows_out'").select("table_name", F.col("value").alias("rows_out"))
    return quality.reconcile(counted, logged, ["table_name"], ["rows_out"])


def _with_customers(operator: Callable[..., DataFrame], t: DerivedTables) -> DataFrame:
    return operator(t["customers"], t["subscriptions"], snapshot=SNAPSHOT)


def _with_invoices(operator: Callable[..., DataFrame], t: DerivedTables) -> DataFrame:
    return operator(t["subscriptions"], t["invoices"], snapshot=SNAPSHOT)


_BUILDERS: dict[str, Callable[[DerivedTables], DataFrame]] = {
    # sources and sinks; those that publish, refresh or run write whole tables to the shared folder and read them back
    "read_raw": _read_raw,
    "read_clean": _read_clean,
    "write_clean": _write_clean,
    "publish_star": _publish_star,
    "publish_tables": _publish_tables,
    "publish_run": _publish_run,
    "refresh_by_month": _refresh_by_month,
    "run_cleaning": _run_cleaning,
    "register_views": _view,
    "metrics_table": _metrics,
    # cleaning
    "clean_country": lambda t: cleaning.clean_country(t["raw_customers"]),
    "parse_messy_date": lambda t: cleaning.parse_messy_date(t["raw_customers"]),
    "null_profile": lambda t: cleaning.null_profile(t["raw_customers"], PROFILED),
    "normalize_name": lambda t: cleaning.normalize_name(t["raw_customers"]),
    "customer_remap": _remap,
    "clean_customers": lambda t: cleaning.clean_customers(t["raw_customers"], _remap(t)),
    "remap_customer_id": lambda t: cleaning.remap_customer_id(
        t["raw_subscriptions"].select("subscription_id", "customer_id"), _remap(t), ["subscription_id"]
    ),
    "clean_subscriptions": lambda t: cleaning.clean_subscriptions(t["raw_subscriptions"], _remap(t)),
    "clean_amount": lambda t: cleaning.clean_amount(t["raw_invoices"]),
    "flag_invoice_outliers": lambda t: cleaning.flag_invoice_outliers(
        t["invoices"], t["subscriptions"], t["plans"]
    ),
    "clean_invoices": lambda t: cleaning.clean_invoices(
        t["raw_invoices"], t["raw_subscriptions"], cleaning.clean_plans(t["raw_plans"])
    ),
    "clean_usage": lambda t: cleaning.clean_usage(t["raw_usage_monthly"], _remap(t)),
    "clean_tickets": lambda t: cleaning.clean_tickets(t["raw_support_tickets"], _remap(t)),
    "cleaning_log": lambda t: cleaning.cleaning_log(t.raw()),
    "clean_plans": lambda t: cleaning.clean_plans(t["raw_plans"]),
    # data quality
    "pk_violations": lambda t: quality.pk_violations(_clean(t)),
    "fk_orphans": lambda t: quality.fk_orphans(_clean(t)),
    "domain_violations": lambda t: quality.domain_violations(_clean(t)),
    "table_row_counts": lambda t: quality.table_row_counts(_clean(t)),
    "reconcile": _reconcile_churn,
    "reconcile_mrr": _reconcile_mrr,
    "reconcile_metrics": _reconcile_metrics,
    "compare_tables": _compare_tables,
    # joins of intervals, and counts from sketches
    "overlapping_tickets": _overlapping_tickets,
    "active_by_overlap": _active_by_overlap,
    "sketched_customers": _sketched_customers,
    "sketched_amounts": _sketched_amounts,
    # recurring revenue
    "subscription_mrr": _mrr,
    "month_spine": lambda t: spine.month_spine(t["subscriptions"], snapshot=SNAPSHOT),
    "active_month_start": lambda t: spine.active_month_start(t["subscriptions"], snapshot=SNAPSHOT),
    "active_overlap": lambda t: spine.active_overlap(t["subscriptions"], snapshot=SNAPSHOT),
    "customer_month_mrr": lambda t: mrr.customer_month_mrr(_mrr(t), snapshot=SNAPSHOT),
    "fact_mrr_waterfall": lambda t: mrr.fact_mrr_waterfall(_mrr(t), snapshot=SNAPSHOT),
    "mrr_waterfall": lambda t: mrr.mrr_waterfall(_mrr(t), snapshot=SNAPSHOT),
    "fact_monthly_subscription": lambda t: mrr.fact_monthly_subscription(_mrr(t), snapshot=SNAPSHOT),
    "pivot_source": _pivot_source,
    "mrr_pivot": lambda t: mrr.mrr_pivot(_pivot_source(t), "plan_tier", TIERS),
    "net_revenue_retention": lambda t: mrr.net_revenue_retention(_mrr(t), snapshot=SNAPSHOT),
    "nrr_gap_value": lambda t: mrr.nrr_gap_value(_mrr(t), snapshot=SNAPSHOT),
    # churn and retention
    "active_customers_by_month": lambda t: churn.active_customers_by_month(t["subscriptions"], snapshot=SNAPSHOT),
    "cancellations": lambda t: churn.cancellations(_mrr(t)),
    "monthly_churn": lambda t: churn.monthly_churn(_mrr(t), snapshot=SNAPSHOT),
    "fact_churn_by_month": lambda t: churn.fact_churn_by_month(_mrr(t), snapshot=SNAPSHOT),
    "cancellations_by_month": lambda t: churn.cancellations_by_month(_mrr(t)),
    "cohort_sizes": lambda t: cohort.cohort_sizes(t["customers"]),
    "cohort_retention": partial(_with_customers, cohort.cohort_retention),
    "fact_cohort_retention": partial(_with_customers, cohort.fact_cohort_retention),
    "cohort_retention_matrix": partial(_with_customers, cohort.cohort_retention_matrix),
    "cohort_m12_summary": partial(_with_customers, cohort.cohort_m12_summary),
    # customer value, usage signals, profiling
    "fact_customer_clv": lambda t: value.fact_customer_clv(
        t["customers"], t["subscriptions"], t["invoices"], snapshot=SNAPSHOT
    ),
    "clv_by_channel": partial(_clv, segment="acquisition_channel"),
    "clv_by_size_band": partial(_clv, segment="company_size_band"),
    "clv_by_country": partial(_clv, segment="country"),
    "clv_by_plan_tier": partial(_clv, segment="plan_tier"),
    "trailing_usage": lambda t: usage.trailing_usage(t["usage_monthly"]),
    "revenue_at_risk": lambda t: usage.revenue_at_risk(t["usage_monthly"], t["customers"], _mrr(t)),
    "customer_tenure": lambda t: value.customer_tenure(t["subscriptions"], snapshot=SNAPSHOT),
    "tenure_summary": lambda t: value.tenure_summary(t["subscriptions"], snapshot=SNAPSHOT),
    "tenure_histogram": lambda t: value.tenure_histogram(t["subscriptions"], snapshot=SNAPSHOT),
    "customer_arpu": partial(_with_invoices, value.customer_arpu),
    "arpu_summary": partial(_with_invoices, value.arpu_summary),
    "arpu_histogram": partial(_with_invoices, value.arpu_histogram),
    "usage_churn_group": lambda t: usage.usage_churn_group(t["usage_monthly"], t["subscriptions"]),
    "usage_before_churn": lambda t: usage.usage_before_churn(t["usage_monthly"], t["subscriptions"]),
    "usage_drop_pct": lambda t: usage.usage_drop_pct(t["usage_monthly"], t["subscriptions"]),
    "invoice_price_check": _price_check,
    "outlier_share": lambda t: invoices.outlier_share(_price_check(t)),
    "invoice_sample": _sample,
    # star schema and monthly report
    "dim_customer": lambda t: star.dim_customer(t["customers"]),
    "dim_plan": lambda t: star.dim_plan(t["plans"]),
    "star_relationships": lambda t: star.star_relationships(star.star_tables(t.clean(), snapshot=SNAPSHOT)),
    "monthly_summary": _summary,
    "business_review": lambda t: report.business_review(_summary(t)),
}


def _comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, since two engines print the same decimal at different scales."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
          for f in df.schema.fields]
    )


def _query(build: Callable[[DerivedTables], DataFrame], spark: SparkSession, folder: str) -> DataFrame:
    return _comparable(build(DerivedTables(spark, folder)))


def queries() -> dict[str, Query]:
    return {name: partial(_query, build) for name, build in _BUILDERS.items()}
