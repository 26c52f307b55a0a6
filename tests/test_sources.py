"""Files as other programs write them, missing keys, white space, cohorts without activity, and how work is arranged."""

from __future__ import annotations

import csv
from datetime import date
from pathlib import Path

import pytest
from tables import SNAPSHOT, STARTER, by, customers, plans, raw, rows, subscriptions, usage

from recurra.functions.dates import messy_date
from recurra.functions.text import canonical_country
from recurra.operators import cleaning, cohort, mrr, quality, ranks
from recurra.operators import usage as usage_ops
from recurra.plans import catalog
from recurra.schemas import CLEAN, MALFORMED, PRIMARY_KEYS, RAW
from recurra.session import shared_dir
from recurra.sources import tables as io
from recurra.sources.derived import DerivedTables
from recurra.sources.jobs import log_cleaning, run_cleaning


def put(folder, **files):
    """Write files as given; tables that are not given get a header only."""
    folder.mkdir(parents=True, exist_ok=True)
    for name, schema in RAW.items():
        (folder / f"{name}.csv").write_text(files.get(name, ",".join(schema.names) + "\n"), encoding="utf-8")


def test_csv_is_read_by_name_and_with_doubled_quotes(spark, tmp_path):
    put(tmp_path, customers=(
        "customer_id,country,company_name,acquisition_channel,company_size_band,signup_date,extra\n"
        '1,USA,"Acme ""West"", LLC",Direct,1-10,2023-01-02,x\n2,UK, Blank ,,,,\n'
    ))
    found = by(io.read_raw(spark, str(tmp_path))["customers"], "customer_id")
    assert found[1] == {
        "customer_id": 1, "company_name": 'Acme "West", LLC', "country": "USA", "company_size_band": "1-10", "signup_date": "2023-01-02",
        "acquisition_channel": "Direct",
    }
    assert found[2]["company_name"] == " Blank " and found[2]["signup_date"] is None


def test_written_csv_is_plain_csv(spark, tmp_path):
    names = ['Acme "West", LLC', " padded ", "tab\tbed", 'say "hi"', "a\\b"]
    people = customers(spark, *[(i, "2025-01-01") for i in range(5)])
    people = people.withColumn("company_name", cleaning.F.element_at(cleaning.F.array(*map(cleaning.F.lit, names)), (people.customer_id + 1).cast("int")))
    empty = {n: spark.createDataFrame([], s) for n, s in CLEAN.items()}
    io.write_clean({**empty, "customers": people.coalesce(1)}, str(tmp_path), "csv")
    file = next((tmp_path / "customers").glob("*.csv"))
    with file.open(newline="", encoding="utf-8") as lines:
        assert [r["company_name"] for r in csv.DictReader(lines)] == names
    back = io.read_clean(spark, str(tmp_path), "csv")["customers"]
    assert sorted(r["company_name"] for r in back.collect()) == sorted(names)


def test_single_files_and_prefixed_names_are_found(spark, tmp_path):
    put(tmp_path / "raw", plans="plan_id,plan_name,tier,monthly_price,annual_price\n1,Starter,Starter,29,290\n")
    clean = run_cleaning(spark, f"{tmp_path}/raw", f"{tmp_path}/clean")
    assert rows(clean["plans"].select("plan_id", "tier")) == [(1, "Starter")]
    for name, schema in CLEAN.items():
        (tmp_path / f"clean_{name}.csv").write_text(",".join(schema.names) + "\n")
    (tmp_path / "clean_usage_monthly.csv").write_text("customer_id,usage_month,login_count,feature_usage_count\n7,2023-09-01,3,4\n")
    assert rows(io.read_clean(spark, str(tmp_path), "csv")["usage_monthly"]) == [(7, date(2023, 9, 1), 3, 4)]


def test_malformed_rows_are_counted(spark, tmp_path):
    put(
        tmp_path, customers=",".join(RAW["customers"].names) + "\nx9,A,USA,,2023-01-01,\n1,B,USA,,2023-01-01,\n2,C\n3,D,USA,,2023-01-01,,more\n",
        invoices=",".join(RAW["invoices"].names) + "\n1,10,2023-01-01,5,paid\n",
    )
    tables = io.read_raw(spark, str(tmp_path), keep_malformed=True)
    assert by(tables["customers"], "company_name")["A"][MALFORMED] is True
    log = by(log_cleaning(spark, str(tmp_path)), "table_name", "metric")
    assert log["customers", "malformed_rows"]["value"] == 3 and log["invoices", "malformed_rows"]["value"] == 0
    assert log["customers", "rows_in"]["value"] == 4


def test_a_missing_column_is_refused(spark, tmp_path):
    put(tmp_path, plans="plan_id,plan_name\n1,Starter\n")
    with pytest.raises(ValueError, match="tier"):
        io.read_raw(spark, str(tmp_path))


@pytest.mark.parametrize("table", list(PRIMARY_KEYS))
def test_missing_keys_are_violations(spark, table):
    tables = {n: spark.createDataFrame([], s) for n, s in CLEAN.items()}
    nothing = tuple(None for _ in CLEAN[table])
    tables[table] = spark.createDataFrame([nothing, nothing], CLEAN[table])
    found = by(quality.pk_violations(tables), "table_name")[table]
    assert (found["n_duplicate_keys"], found["n_surplus_rows"], found["n_null_keys"]) == (0, 0, 2)
    with pytest.raises(ValueError, match=f"key {table}: 2"):
        io.publish_tables(tables, "default")


def test_row_counts_against_what_was_expected(spark):
    counted = quality.table_row_counts({"plans": plans(spark)}, {"plans": 3})
    assert rows(counted) == [("plans", 3, 3, "match")]
    assert rows(quality.table_row_counts({"plans": plans(spark)}, {"plans": 4}))[0][3] == "diff"


@pytest.mark.parametrize("around", ["\t", "\r", " ", "\n ", "  "])
def test_white_space_of_any_kind_is_stripped(spark, around):
    people = raw(spark, "customers", (1, "A", f"{around}USA{around}", None, f"{around}2023-01-02{around}", None))
    found = people.select(canonical_country(people.country), messy_date(people.signup_date))
    assert rows(found) == [("United States", date(2023, 1, 2))]


def test_a_cohort_without_activity_has_a_row(spark):
    people = customers(spark, (1, "2025-01-05"), (2, "2025-03-05"), (3, "2024-01-05"))
    subs = subscriptions(spark, (1, STARTER, "2025-01-05", None))
    cells = by(cohort.cohort_retention_matrix(people, subs, snapshot=SNAPSHOT), "cohort_month")
    assert cells[date(2025, 3, 1)]["m0"] == 0 and cells[date(2025, 3, 1)]["m9"] == 0 and cells[date(2025, 3, 1)]["m10"] is None
    assert cells[date(2025, 1, 1)]["m0"] == 100
    assert set(by(cohort.cohort_retention_matrix(people, subs, snapshot=SNAPSHOT, newest=2), "cohort_month")) == {date(2025, 3, 1), date(2025, 1, 1)}
    assert rows(cohort.cohort_m12_summary(people, subs, snapshot=SNAPSHOT))[0][3] == 0



def test_a_parent_is_read_once_for_all_its_children(spark):
    tables = {n: spark.range(5).select(*[cleaning.F.lit(1).cast(f.dataType).alias(f.name) if f.dataType.simpleString() in ("int", "bigint") else cleaning.F.lit(None).cast(f.dataType).alias(f.name) for f in s]) for n, s in CLEAN.items()}
    plan = quality.fk_orphans(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftOuter") == 3 and "LeftAnti" not in plan


def test_usage_is_reduced_before_it_is_put_in_order(spark):
    subs = subscriptions(spark, (1, STARTER, "2025-01-01", None))
    people = customers(spark, (1, "2025-01-01"), (2, "2025-01-01"))
    logins = usage(spark, *[(c, f"2025-{m:02}-01", 50 if m < 12 else 1) for c in (1, 2) for m in range(1, 13)])
    found = usage_ops.revenue_at_risk(logins, people, mrr.subscription_mrr(subs, plans(spark)))
    assert [r["customer_id"] for r in found.collect()] == [1]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window [") < plan.index("sum(", plan.index("Window [") + 200)


def test_values_that_share_their_leading_digits_are_told_apart_in_steps(spark):
    values = spark.range(1_000_000).selectExpr("12345000000000 + id * 7 AS value")
    counts = ranks.value_counts(values, "value")
    assert ranks.median_and_mean(counts).first()["median2"] == 2 * 12345000000000 + 7 * 999_999
    # Five digits at most are new in a step, so a step orders 10^5 buckets at most.
    assert all(b - a <= 5 for a, b in zip((0, *ranks.NARROWING), ranks.NARROWING))


def test_round_trips_leave_no_folder(spark):
    assert catalog._read_raw(DerivedTables(spark, "/root/testdata/sf0.001")).count() == 6
    assert not list(Path(shared_dir(spark)).glob("recurra-*"))
