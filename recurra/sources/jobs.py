"""Whole jobs: raw tables to clean ones, clean tables to the published star schema."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recurra.functions.dates import is_ambiguous_date, messy_date
from recurra.functions.text import canonical_country
from recurra.operators import cleaning
from recurra.operators.star import star_tables
from recurra.schemas import CLEAN, MALFORMED, RAW
from recurra.session import shared_dir
from recurra.sources.files import removed
from recurra.sources.tables import malformed_records, publish_star, read_clean, read_raw

_LOG = "table_name string, metric string, value bigint"


class CleanTables(dict[str, DataFrame]):
    """The written tables by name; `log` is what cleaning met and did, as (table_name, metric, value)."""

    def __init__(self, tables: dict[str, DataFrame], log: DataFrame) -> None:
        super().__init__(tables)
        self.log = log


def _write_counted(rows: DataFrame, path: str, columns: list[str], **counts: Column) -> dict[str, int]:
    """Write `columns` of rows and return what was counted on the way.

    Counts are observed in the tasks that write, whose attempts count once, and not before a shuffle, where a task that is run again after
    a lost executor would count twice.
    """
    observed = Observation()
    rows.observe(observed, *[count.alias(name) for name, count in counts.items()]).select(columns).write.mode("overwrite").parquet(path)
    return {name: value or 0 for name, value in observed.get.items()}


def run_cleaning(spark: SparkSession, raw_folder: str, clean_folder: str, fmt: str = "csv", *, multi_line: bool = False) -> CleanTables:
    """Clean the raw tables in a folder and return the written result, with the log.

    Every raw table is read once: what the log says is counted while its clean table is written. Customers are needed twice, for the
    duplicates and for their own table, and are kept in the shared folder meanwhile. Invoices are priced by the clean subscriptions and plans.
    """
    raw = read_raw(spark, raw_folder, fmt, keep_malformed=fmt == "csv", multi_line=multi_line)
    broken = {name: F.count_if(MALFORMED) for name, df in raw.items() if MALFORMED in df.columns}
    rows = F.count(F.lit(1))
    log: dict[str, dict[str, int]] = {}

    def malformed(name: str) -> dict[str, Column]:
        return {"malformed_rows": broken[name]} if name in broken else {}

    def place(name: str) -> str:
        return f"{clean_folder}/{name}"

    def keeping_rows(name: str, df: DataFrame, **counts: Column) -> None:
        found = _write_counted(df, place(name), CLEAN[name].names, rows_in=rows, **counts, **malformed(name))
        log[name] = {"rows_in": found["rows_in"], "rows_out": found["rows_in"], **found}

    staged = f"{shared_dir(spark)}/recurra-cleaning-{uuid.uuid4().hex}"
    signup, spelling = F.col("signup_date"), F.col("country")
    try:
        log["customers"] = _write_counted(
            raw["customers"], staged, RAW["customers"].names, rows_in=rows, ambiguous_dates=F.count_if(is_ambiguous_date(signup)),
            failed_dates=F.count_if(messy_date(signup).isNull()), unmapped_countries=F.count_if(canonical_country(spelling).isNull()),
            missing_company_size_band=F.count_if(F.col("company_size_band").isNull()),
            missing_acquisition_channel=F.count_if(F.col("acquisition_channel").isNull()), **malformed("customers"),
        )
        customers = spark.read.schema(RAW["customers"]).parquet(staged)
        # Different values cannot be observed; this reads one column of the kept copy.
        different = customers.select("country").distinct().agg(
            F.count(spelling).alias("raw_countries"), F.countDistinct(canonical_country(spelling)).alias("canonical_countries")
        ).first()
        remap = cleaning.cut_lineage(cleaning.customer_remap(customers))
        kept = _write_counted(cleaning.clean_customers(customers, remap), place("customers"), CLEAN["customers"].names, rows_out=rows)
        log["customers"] |= {**different.asDict(), **kept, "merged_duplicates": log["customers"]["rows_in"] - kept["rows_out"]}
    finally:
        removed(spark, staged)

    keeping_rows("plans", cleaning.clean_plans(raw["plans"], MALFORMED in raw["plans"].columns))
    start = F.col("start_date")
    judged = raw["subscriptions"].withColumns({"_ambiguous": is_ambiguous_date(start), "_failed": messy_date(start).isNull()})
    keeping_rows(
        "subscriptions", cleaning.clean_subscriptions(judged, remap), ambiguous_dates=F.count_if("_ambiguous"), failed_dates=F.count_if("_failed")
    )
    written = {name: spark.read.schema(CLEAN[name]).parquet(place(name)) for name in ("plans", "subscriptions")}
    keeping_rows(
        "invoices", cleaning.typed_invoices(raw["invoices"], written["subscriptions"], written["plans"]), formatted_amounts=F.count_if("was_formatted"),
        failed_amounts=F.count_if(F.col("amount").isNull()), outliers=F.count_if("is_outlier"), failed_dates=F.count_if(F.col("invoice_date").isNull()),
    )
    summed = [rows.alias("_rows"), *[count.alias("_malformed") for name, count in broken.items() if name == "usage_monthly"]]
    log["usage_monthly"] = _write_counted(
        cleaning.clean_usage(raw["usage_monthly"], remap, *summed), place("usage_monthly"), CLEAN["usage_monthly"].names, rows_in=F.sum("_rows"), rows_out=rows,
        **({"malformed_rows": F.sum("_malformed")} if "usage_monthly" in broken else {}),
    )
    keeping_rows("support_tickets", cleaning.clean_tickets(raw["support_tickets"], remap))
    lines = [(name, metric, int(value)) for name, counts in log.items() for metric, value in counts.items()]
    return CleanTables(read_clean(spark, clean_folder), spark.createDataFrame(lines, _LOG))


def log_cleaning(spark: SparkSession, raw_folder: str, fmt: str = "csv") -> DataFrame:
    """What cleaning would meet in a folder of raw tables, malformed rows among it; nothing is written."""
    return cleaning.cleaning_log(read_raw(spark, raw_folder, fmt, keep_malformed=fmt == "csv"))


def quarantine(
    spark: SparkSession, raw_folder: str, folder: str, *, most: float = 0.01, multi_line: bool = False, run: str = "latest"
) -> DataFrame:
    """Put the malformed rows of the raw CSV tables into `folder`, by run and table, and return them: table_name, file, record, reasons.

    All tables are looked at, each in one pass, before a job stops: a table more than `most` of whose rows are malformed is an error, and what
    was found can be read in the folder. A run that is repeated replaces what it left.
    """
    rates = {}
    for name, schema in RAW.items():
        rows = malformed_records(spark, raw_folder, name, schema, multi_line=multi_line)
        observed = Observation()
        bad = F.size("reasons") > 0
        counted = rows.observe(observed, F.count(F.lit(1)).alias("all"), F.count_if(bad).alias("bad"))
        counted.where(bad).drop("table_name").write.mode("overwrite").parquet(f"{folder}/run={run}/table_name={name}")
        found = observed.get
        rates[name] = (found["bad"], found["all"])
    above = {name: rate for name, rate in rates.items() if rate[0] > most * rate[1]}
    if above:
        raise ValueError("too many malformed rows: " + ", ".join(f"{name} {bad} of {whole}" for name, (bad, whole) in above.items()))
    return spark.read.parquet(f"{folder}/run={run}").select("table_name", "file", "record", "reasons")


def run_star(spark: SparkSession, clean_folder: str, star_folder: str, *, snapshot: date) -> None:
    publish_star(star_tables(read_clean(spark, clean_folder), snapshot=snapshot), star_folder)
