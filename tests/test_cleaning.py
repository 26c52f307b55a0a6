"""Cleaning as a whole, duplicate merging under skew, and the quality checks."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tables import SNAPSHOT, by, customers, plans, raw, rows, subscriptions

from recurra.operators import cleaning, joins, quality
from recurra.operators.star import star_tables
from recurra.operators.usage import trailing_usage
from recurra.session import CHECKPOINT_CONF, shared_dir
from recurra.sources import tables as io
from recurra.sources.jobs import run_cleaning, run_star


def messy(spark):
    return {
        "customers": raw(
            spark, "customers",
            (1, "Acme LLC", "USA", "1-10", "2023-01-05", "Direct"),
            (2, "Beta", " u.k. ", None, "13-Sep-2023", None),
            (3, "Gamma", "Atlantis", "11-50", "03/04/2023", "Referral"),
            (9, " ACME L.L.C. ", "US", "1-10", "05/01/2023", "Direct"),
        ),
        "plans": raw(spark, "plans", (1, "Starter", "Starter", "29", "290")),
        "subscriptions": raw(
            spark, "subscriptions",
            (10, 9, 1, "04/13/2023", "", "monthly", "active"), (11, 2, 1, "2023-09-20", "2023-12-01", "annual", "cancelled"),
        ),
        "invoices": raw(
            spark, "invoices",
            (100, 10, "2023-05-01", "$29.00", "paid"), (101, 10, "01/06/2023", "2900", "paid"),
            (102, 11, "20-Sep-2023", "290.00", "failed"), (103, 11, "2023-10-20", "N/A", "paid"),
        ),
        "usage_monthly": raw(
            spark, "usage_monthly", (1, "2023-05", 3, 30), (9, "2023-05", 4, 40), (9, "2023-06", 5, 50), (2, "2023-10", 6, 60),
        ),
        "support_tickets": raw(
            spark, "support_tickets", (7, 9, "2023-05-02", "", "High", "Billing"), (8, 2, "2023-11-02", "2023-11-03", "Low", "Other"),
        ),
    }


def test_cleaning_end_to_end(spark, tmp_path):
    for name, df in messy(spark).items():
        df.write.option("header", True).csv(f"{tmp_path}/raw/{name}")
    clean = run_cleaning(spark, f"{tmp_path}/raw", f"{tmp_path}/clean")
    people = by(clean["customers"], "customer_id")
    assert set(people) == {1, 2, 3}
    assert people[1]["company_name"] == "Acme LLC"
    assert [people[c]["country"] for c in (1, 2, 3)] == ["United States", "United Kingdom", None]
    assert (people[3]["signup_date"], people[3]["signup_date_ambiguous"]) == (date(2023, 4, 3), True)
    assert people[2]["company_size_band"] is None and people[2]["acquisition_channel"] is None
    subs = by(clean["subscriptions"], "subscription_id")
    assert (subs[10]["customer_id"], subs[10]["start_date"], subs[10]["end_date"]) == (1, date(2023, 4, 13), None)
    bills = by(clean["invoices"], "invoice_id")
    assert [bills[i]["is_outlier"] for i in (100, 101, 102, 103)] == [False, True, False, False]
    assert (bills[100]["amount"], bills[103]["amount"]) == (Decimal(29), None)
    assert bills[101]["invoice_date"] == date(2023, 6, 1)
    used = by(clean["usage_monthly"], "customer_id", "usage_month")
    assert used[1, date(2023, 5, 1)]["login_count"] == 7
    assert used[1, date(2023, 6, 1)]["feature_usage_count"] == 50
    tickets = by(clean["support_tickets"], "ticket_id")
    assert (tickets[7]["customer_id"], tickets[7]["resolved_date"]) == (1, None)


def test_cleaning_log(spark):
    log = {(t, m): v for t, m, v in rows(cleaning.cleaning_log(messy(spark)))}
    expected = {
        ("customers", "rows_in"): 4, ("customers", "rows_out"): 3, ("customers", "raw_countries"): 4,
        ("customers", "canonical_countries"): 2, ("customers", "unmapped_countries"): 1,
        ("customers", "ambiguous_dates"): 2, ("customers", "failed_dates"): 0, ("customers", "merged_duplicates"): 1,
        ("customers", "missing_company_size_band"): 1, ("customers", "missing_acquisition_channel"): 1,
        ("invoices", "formatted_amounts"): 1, ("invoices", "failed_amounts"): 1, ("invoices", "outliers"): 1,
        ("usage_monthly", "rows_in"): 4, ("usage_monthly", "rows_out"): 3,
    }
    assert {k: log[k] for k in expected} == expected


def test_null_profile(spark):
    profile = by(cleaning.null_profile(messy(spark)["customers"], ["company_size_band", "country"]), "column_name")
    assert (profile["company_size_band"]["n_missing"], profile["company_size_band"]["pct_missing"]) == (1, Decimal("25.0"))
    assert profile["country"]["n_missing"] == 0


def test_one_name_held_by_a_third_of_all_customers(spark):
    ids = spark.range(1, 3001)
    name = F.when(F.col("id") % 3 == 0, " The SAME co.").otherwise(F.concat(F.lit("c"), F.col("id")))
    people = ids.select(
        F.col("id").alias("customer_id"), name.alias("company_name"), F.lit("US").alias("country"),
        F.lit(None).cast("string").alias("company_size_band"), F.lit("2023-01-01").alias("signup_date"),
        F.lit(None).cast("string").alias("acquisition_channel"),
    )
    remap = cleaning.customer_remap(people)
    assert {c for _, c in rows(remap)} == {3} and remap.count() == 999
    assert cleaning.clean_customers(people, remap).count() == 2001
    hot = spark.range(900).select(F.col("id").alias("ticket_id"), F.lit(6).cast("bigint").alias("customer_id"))
    moved = cleaning.remap_customer_id(hot, remap, ["ticket_id"])
    assert moved.where("customer_id = 3").count() == 900


def test_salted_joins_spread_one_key_over_tasks(spark):
    big = spark.range(8000).select(F.col("id"), F.lit(1).alias("k"))
    salts = big.select(F.pmod(F.xxhash64("id"), F.lit(joins.SALTS)).alias("s")).groupBy("s").count()
    counts = [r["count"] for r in salts.collect()]
    assert len(counts) == joins.SALTS and max(counts) < 2 * min(counts)
    small = spark.createDataFrame([(1, "x")], "k int, v string")
    joined = joins.spread_join(big, small, "k", ["id"])
    assert joined.count() == 8000 and joined.where("v = 'x'").count() == 8000


def test_a_lookup_past_the_limit_is_not_broadcast(spark, monkeypatch):
    fact = spark.range(100).withColumnRenamed("id", "k")
    lookup = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    small = joins.lookup_join(fact, lookup, "k")
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(joins, "LOOKUP_MAX_ROWS", 49)
    large = joins.lookup_join(fact, lookup, "k")
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    assert sorted(rows(small)) == sorted(rows(large))


def test_hot_subscriptions_are_split_at_run_time(spark):
    """A third of all invoices on one subscription: the shuffle join splits that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(0, 200_000, 1, 8)
        hot = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 900 + 2).cast("bigint")
        bills = ids.select(
            F.col("id").alias("invoice_id"), hot.alias("subscription_id"), F.lit("2023-01-01").alias("invoice_date"),
            F.concat(F.lit("$"), (F.col("id") % 300).cast("string")).alias("amount"), F.lit("paid").alias("payment_status"),
        )
        subs = spark.range(1, 902).select(
            F.col("id").alias("subscription_id"), F.lit(1).alias("plan_id"), F.lit("monthly").alias("billing_cycle")
        )
        cleaned = cleaning.clean_invoices(bills, subs, plans(spark))
        odd = cleaned.where("is_outlier").select("invoice_id")
        amount = F.col("id") % 300
        assert len(odd.collect()) == ids.where((amount > 145) | (amount < 5.8)).count()
        assert "skew=true" in odd._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def clean_set(spark):
    tables = cleaning.clean_tables(messy(spark))
    kept = {**tables, "customers": tables["customers"].where("country is not null")}
    return kept


def test_quality_checks_find_what_is_broken(spark):
    tables = clean_set(spark)
    assert all(r["n_surplus_rows"] == 0 for r in quality.pk_violations(tables).collect())
    assert all(r["n_orphans"] == 0 for r in quality.fk_orphans(tables).collect())
    broken = {(r["table_name"], r["rule"]): r["n_violations"] for r in quality.domain_violations(tables).collect() if r["n_violations"]}
    assert broken == {("invoices", "amount is required"): 1}
    twice = {**tables, "subscriptions": tables["subscriptions"].union(tables["subscriptions"])}
    assert by(quality.pk_violations(twice), "table_name")["subscriptions"]["n_surplus_rows"] == 2
    fewer = {**tables, "customers": tables["customers"].where("customer_id = 1")}
    orphans = by(quality.fk_orphans(fewer), "child_table", "fk_column")
    assert orphans["subscriptions", "customer_id"]["n_orphans"] == 1
    assert by(quality.table_row_counts(tables), "table_name")["invoices"]["n_rows"] == 4


def test_reconcile(spark):
    left = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (5, None)], "k int, v double")
    right = spark.createDataFrame([(1, 1.0), (2, 2.5), (4, 4.0), (5, None)], "k int, v double")
    compared = by(quality.reconcile(left, right, ["k"], ["v"]), "k")
    assert {k: r["status"] for k, r in compared.items()} == {
        1: "match", 2: "diff", 3: "left_only", 4: "right_only", 5: "match",
    }
    assert compared[2]["difference"] == Decimal("-0.5")
    near = by(quality.reconcile(left, right, ["k"], ["v"], tolerance=0.5), "k")
    assert near[2]["status"] == "match"


def test_publishing_needs_clean_tables(spark, tmp_path):
    tables = clean_set(spark)
    with pytest.raises(ValueError, match="invoices: amount is required: 1"):
        io.publish_tables(tables, "default")
    passing = {**tables, "invoices": tables["invoices"].where("amount is not null")}
    io.write_clean(passing, f"{tmp_path}/clean")
    written = io.read_clean(spark, f"{tmp_path}/clean")
    try:
        for _ in range(2):  # the second load replaces the first
            io.publish_tables(written, "default")
        assert {r["n_rows"] for r in quality.table_row_counts({"invoices": spark.table("default.invoices")}).collect()} == {3}
        assert spark.table("default.customers").schema == written["customers"].schema
        io.publish_tables(written, "default", buckets=4)
        stored = spark.table("default.usage_monthly")
        assert sorted(rows(stored)) == sorted(rows(written["usage_monthly"]))
        assert "Exchange" not in trailing_usage(stored)._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in written:
            spark.sql(f"DROP TABLE IF EXISTS default.{name}")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_clean_tables_round_trip(spark, tmp_path, fmt):
    tables = clean_set(spark)
    io.write_clean(tables, str(tmp_path), fmt)
    back = io.read_clean(spark, str(tmp_path), fmt)
    for name, df in tables.items():
        assert sorted(map(repr, rows(back[name].select(df.columns)))) == sorted(map(repr, rows(df)))


def test_an_unknown_format_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="xml"):
        io.read_raw(spark, str(tmp_path), "xml")


def test_star_is_stored_by_month_and_month_filters_prune(spark, tmp_path):
    io.write_clean(clean_set(spark), f"{tmp_path}/clean")
    run_star(spark, f"{tmp_path}/clean", f"{tmp_path}/star", snapshot=SNAPSHOT)
    clean = io.read_clean(spark, f"{tmp_path}/clean")
    for name, df in star_tables(clean, snapshot=SNAPSHOT).items():
        stored = spark.read.parquet(f"{tmp_path}/star/{name}").select(df.columns)
        assert sorted(map(repr, rows(stored))) == sorted(map(repr, rows(df))), name
    one = spark.read.parquet(f"{tmp_path}/star/fact_monthly_subscription").where("month = DATE '2023-06-01'")
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().executedPlan().toString()


def test_views_and_metrics(spark, tmp_path):
    subs = subscriptions(spark, (1, 1, "2025-01-01", None))
    io.register_views({"subscriptions": subs, "plans": plans(spark), "customers": customers(spark, (1, "2025-01-01"))})
    assert spark.sql("SELECT sum(mrr) FROM subscription_mrr").collect()[0][0] == Decimal(29)
    log = spark.sql("SELECT 't' AS table_name, 'rows_in' AS metric, 4L AS value")
    metrics = io.metrics_table([("a", spark.sql("SELECT 1 AS x, 2.5 AS y")), ("b", spark.sql("SELECT 3 AS x"))], log)
    expected = [("a", "x", 1.0), ("a", "y", 2.5), ("b", "x", 3.0), ("cleaning", "t.rows_in", 4.0)]
    assert sorted(rows(metrics)) == expected
    for run in ("first", "second", "second"):
        io.write_metrics(metrics, str(tmp_path), run=run)
    kept = spark.read.parquet(str(tmp_path))
    assert sorted(rows(kept.where("run = 'second'").drop("run"))) == expected and kept.count() == 8


def test_the_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get(CHECKPOINT_CONF)
