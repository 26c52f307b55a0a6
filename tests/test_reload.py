"""Cleaning runs with their log, quarantined rows, reloads that are whole or not there, and reloads of single months."""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tables import STARTER, by, customers, invoices, plans, rows, subscriptions, usage

from recurra.operators import quality
from recurra.schemas import CLEAN, RAW
from recurra.session import shared_dir
from recurra.sources import jobs, publishing
from recurra.sources import tables as io
from recurra.sources.derived import DerivedTables


def put(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, schema in RAW.items():
        (folder / f"{name}.csv").write_text(files.get(name, ",".join(schema.names) + "\n"), encoding="utf-8")


def header(name):
    return ",".join(RAW[name].names) + "\n"


MESSY = {
    "customers": header("customers") + '1,Acme LLC,USA,1-10,2023-01-02,Direct\n2,ACME llc,Nowhere,,03/04/2023,\n3,"B, Inc",UK,1-10,13/45/2023,Direct\nx,D,UK,,2023-01-01,\n',
    "plans": header("plans") + "1,Starter,Starter,29,290\n",
    "subscriptions": header("subscriptions") + "10,1,1,2023-01-02,,monthly,active\n11,2,1,05/06/2023,,monthly,active\n12,3,1,never,,annual,active\n",
    "invoices": header("invoices") + '100,10,2023-01-03,"$1,000.00",paid\n101,10,2023-02-03,29,paid\n102,11,bad,N/A,paid\n103,12\n',
    "usage_monthly": header("usage_monthly") + "1,2023-01,5,6\n2,2023-01,7,8\n3,2023-02,1,x\n",
    "support_tickets": header("support_tickets") + "1,2,2023-01-01,,Low,Billing\n",
}


def as_lines(log):
    return sorted((r["table_name"], r["metric"], r["value"]) for r in log.collect())


def test_the_log_comes_from_the_writes(spark, tmp_path):
    put(tmp_path / "raw", **MESSY)
    written = jobs.run_cleaning(spark, f"{tmp_path}/raw", f"{tmp_path}/clean")
    assert as_lines(written.log) == as_lines(jobs.log_cleaning(spark, f"{tmp_path}/raw"))
    found = by(written.log, "table_name", "metric")
    assert found["customers", "merged_duplicates"]["value"] == 1 and found["customers", "unmapped_countries"]["value"] == 1
    assert found["invoices", "malformed_rows"]["value"] == 1 and found["usage_monthly", "rows_out"]["value"] == 2
    assert set(written) == set(CLEAN) and written["invoices"].count() == 4
    assert not list(Path(shared_dir(spark)).glob("recurra-cleaning-*"))


def test_the_log_of_nothing(spark, tmp_path):
    put(tmp_path / "raw")
    written = jobs.run_cleaning(spark, f"{tmp_path}/raw", f"{tmp_path}/clean")
    assert as_lines(written.log) == as_lines(jobs.log_cleaning(spark, f"{tmp_path}/raw"))
    assert all(r["value"] == 0 for r in written.log.collect())


def test_the_log_of_the_test_tables(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("no test tables")
    raw = DerivedTables(spark, folder).raw()
    for name, df in raw.items():
        df.select(*[F.col(f.name).cast(f.dataType) for f in RAW[name]]).write.parquet(f"{tmp_path}/raw/{name}")
    written = jobs.run_cleaning(spark, f"{tmp_path}/raw", f"{tmp_path}/clean", "parquet")
    assert as_lines(written.log) == as_lines(jobs.log_cleaning(spark, f"{tmp_path}/raw", "parquet"))


def test_every_raw_table_is_read_once(spark, tmp_path, monkeypatch):
    put(tmp_path / "raw", **MESSY)
    read = {name: spark.sparkContext.accumulator(0) for name in RAW}
    whole = {name: df.count() for name, df in io.read_raw(spark, f"{tmp_path}/raw", keep_malformed=True).items()}

    def counted(df, seen):
        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return df.mapInArrow(count, df.schema)

    def reading(*args, **options):
        return {name: counted(df, read[name]) for name, df in io.read_raw(*args, **options).items()}

    monkeypatch.setattr(jobs, "read_raw", reading)
    jobs.run_cleaning(spark, f"{tmp_path}/raw", f"{tmp_path}/clean")
    assert {name: seen.value for name, seen in read.items()} == whole


def test_line_breaks_in_quotes(spark, tmp_path):
    put(tmp_path, customers=header("customers") + '3,"US\nA",C,1-10,2023-01-02,Direct\n4,"say ""hi""",USA,,2023-01-02,"a\nb"\n')
    for last in (False, True):
        with pytest.raises(Exception, match="multi_line"):
            io.read_raw(spark, str(tmp_path))["customers"].select("customer_id").collect() if last else io.read_raw(spark, str(tmp_path))["customers"].collect()
    found = by(io.read_raw(spark, str(tmp_path), multi_line=True)["customers"], "customer_id")
    assert found[3]["company_name"] == "US\nA" and found[4]["acquisition_channel"] == "a\nb" and found[4]["company_name"] == 'say "hi"' and len(found) == 2
    kept = io.read_raw(spark, str(tmp_path), keep_malformed=True)["customers"]
    # What stands before a line break in the last value has as many values as a whole row; the rest has not.
    assert kept.where("_malformed").count() == 3
    written = jobs.run_cleaning(spark, str(tmp_path), f"{tmp_path}/clean", multi_line=True)
    assert by(written.log, "table_name", "metric")["customers", "malformed_rows"]["value"] == 0


def test_malformed_rows_go_to_quarantine(spark, tmp_path):
    put(tmp_path / "raw", **MESSY)
    with pytest.raises(ValueError, match="customers 1 of 4"):
        jobs.quarantine(spark, f"{tmp_path}/raw", f"{tmp_path}/bad", most=0.1)
    found = jobs.quarantine(spark, f"{tmp_path}/raw", f"{tmp_path}/bad", most=0.5, run="second")
    lines = sorted((r["table_name"], r["file"].rsplit("/", 1)[1], r["record"], tuple(r["reasons"])) for r in found.collect())
    assert lines == [
        ("customers", "customers.csv", "x,D,UK,,2023-01-01,", ("value of customer_id",)), ("invoices", "invoices.csv", "103,12", ("number of values",)),
        ("usage_monthly", "usage_monthly.csv", "3,2023-02,1,x", ("value of feature_usage_count",)),
    ]
    log = jobs.run_cleaning(spark, f"{tmp_path}/raw", f"{tmp_path}/clean").log
    assert sum(r["value"] for r in log.where("metric = 'malformed_rows'").collect()) == len(lines)
    again = jobs.quarantine(spark, f"{tmp_path}/raw", f"{tmp_path}/bad", most=0.5, run="second")
    assert again.count() == 3


def clean_set(spark, extra=0):
    return {
        "customers": customers(spark, (1, "2025-01-01"), *[(10 + i, "2025-01-01") for i in range(extra)]), "plans": plans(spark),
        "subscriptions": subscriptions(spark, (1, STARTER, "2025-01-01", None)), "invoices": invoices(spark, (1, 29)),
        "usage_monthly": usage(spark, (1, "2025-01-01", 3)), "support_tickets": spark.createDataFrame([], CLEAN["support_tickets"]),
    }


def test_a_reload_is_whole_or_not_there(spark, tmp_path, monkeypatch):
    folder = f"{tmp_path}/published"
    with pytest.raises(ValueError, match="nothing is published"):
        publishing.read_published(spark, folder)
    publishing.publish_run(clean_set(spark), folder, run="a")
    before = publishing.read_published(spark, folder)
    assert before["customers"].count() == 1

    def fails(tables, place):
        done = dict(list(tables.items())[:3])
        io.write_clean(done, place)
        raise OSError("disk full at the fourth table")

    with monkeypatch.context() as patched:
        patched.setattr(publishing, "write_clean", fails)
        with pytest.raises(OSError, match="fourth"):
            publishing.publish_run(clean_set(spark, 5), folder, run="b")
    assert {n: df.count() for n, df in publishing.read_published(spark, folder).items()} == {n: df.count() for n, df in clean_set(spark).items()}
    # Tables that break a rule are written and never switched to.
    broken = clean_set(spark, 5) | {"subscriptions": subscriptions(spark, (77, STARTER, "2025-01-01", None))}
    with pytest.raises(ValueError, match="subscriptions.customer_id: 1"):
        publishing.publish_run(broken, folder, run="b")
    assert publishing.current_run(spark, folder) == "a"
    publishing.publish_run(clean_set(spark, 5), folder, run="b")
    assert publishing.read_published(spark, folder)["customers"].count() == 6 and before["customers"].count() == 1
    with pytest.raises(ValueError, match="already"):
        publishing.publish_run(clean_set(spark), folder, run="b")
    with pytest.raises(ValueError, match="no name"):
        publishing.publish_run(clean_set(spark), folder, run="../b")
    publishing.publish_run(clean_set(spark, 2), folder, run="c")
    assert publishing.drop_old_runs(spark, folder, keep=1) == ["a"]
    assert publishing.read_published(spark, folder)["customers"].count() == 3


FACT = "month date, customer_id bigint, mrr decimal(12,2)"


def months(spark, changes=()):
    cells = {(m, c): Decimal(10 * m + c) for m in range(1, 7) for c in range(5)}
    cells |= dict(changes)
    return spark.createDataFrame([(date(2025, m, 1), c, v) for (m, c), v in cells.items() if v is not None], FACT).repartition(3)


def files_of(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in Path(folder).rglob("*.parquet")}


def test_only_changed_months_are_written(spark, tmp_path):
    folder = f"{tmp_path}/fact"
    assert {r["status"] for r in publishing.refresh_by_month(months(spark), folder).collect()} == {"added"}
    first = files_of(f"{folder}/data")
    assert {r["status"] for r in publishing.refresh_by_month(months(spark).orderBy(F.desc("mrr")), folder).collect()} == {"same"}
    assert files_of(f"{folder}/data") == first
    changes = {(3, 2): Decimal(999), (5, 0): None, (9, 1): Decimal(1), **{(6, c): None for c in range(5)}}
    done = by(publishing.refresh_by_month(months(spark, changes.items()), folder), "month")
    assert {m.month: r["status"] for m, r in done.items()} == {1: "same", 2: "same", 3: "rewritten", 4: "same", 5: "rewritten", 6: "removed", 9: "added"}
    stored = spark.read.schema(FACT).parquet(f"{folder}/data")
    assert sorted(rows(stored.select("month", "customer_id", "mrr"))) == sorted(rows(months(spark, changes.items())))
    second = files_of(f"{folder}/data")
    assert {n for n in first if second.get(n) == first[n]} == {n for n in first if any(f"2025-0{m}" in n for m in (1, 2, 4))}


def test_a_month_without_digest_is_written_again(spark, tmp_path, monkeypatch):
    folder = f"{tmp_path}/fact"
    publishing.refresh_by_month(months(spark), folder)
    calls = []

    def dies(df, path):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("died after the data were written")
        df.write.mode("overwrite").parquet(path)

    with monkeypatch.context() as patched:
        patched.setattr(publishing, "replace_folder", dies)
        with pytest.raises(OSError):
            publishing.refresh_by_month(months(spark, {(3, 2): Decimal(999)}.items()), folder)
    done = by(publishing.refresh_by_month(months(spark), folder), "month")
    assert {m.month for m, r in done.items() if r["status"] != "same"} == {3}
    assert sorted(rows(spark.read.schema(FACT).parquet(f"{folder}/data").select("month", "customer_id", "mrr"))) == sorted(rows(months(spark)))


def test_rows_without_a_month_are_a_month(spark, tmp_path):
    table = spark.createDataFrame([(None, 1, Decimal(1)), (date(2025, 1, 1), 1, Decimal(2))], FACT)
    for expected in ("added", "same"):
        assert {r["status"] for r in publishing.refresh_by_month(table, f"{tmp_path}/f").collect()} == {expected}
    left = table.where("month is not null")
    assert by(publishing.refresh_by_month(left, f"{tmp_path}/f"), "month")[None]["status"] == "removed"
    assert spark.read.schema(FACT).parquet(f"{tmp_path}/f/data").count() == 1


@pytest.mark.parametrize("a, b", [([(1, None), (2, 3)], [(1, 2), (None, 3)]), ([(1, 1), (1, 1)], [(2, 2), (2, 2)]), ([(1, 1)], [(1, 1), (1, 1)])])
def test_digests_tell_tables_apart(spark, a, b):
    frames = [spark.createDataFrame(side, "x int, y int").withColumn("k", F.lit(1)) for side in (a, b)]
    first, second = (tuple(publishing.digests_by(f, "k").first()) for f in frames)
    assert first != second
    assert tuple(publishing.digests_by(frames[0].orderBy(F.desc("y")), "k").first()) == first


def test_row_counts_stay_with_quality(spark):
    assert quality.table_row_counts(clean_set(spark)).count() == 6
