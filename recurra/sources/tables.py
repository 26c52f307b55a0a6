"""Tables in and out: raw and clean reads, clean writes, publishing, views and the metrics table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from recurra.operators.mrr import subscription_mrr
from recurra.operators.quality import domain_violations, fk_orphans, pk_violations
from recurra.operators.star import BY_MONTH
from recurra.schemas import CLEAN, MALFORMED, RAW
from recurra.sources.files import exists

FORMATS = ("csv", "parquet")
CSV_OUT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

# Tables whose key bounds the rows per customer, so no bucket outgrows the others. The other tables may hold
# any number of rows for one customer and are left to shuffles, which can be split.
BUCKETED = {"customers": "customer_id", "usage_monthly": "customer_id"}


def _stored_at(spark: SparkSession, folder: str, name: str, fmt: str, prefixes: Sequence[str]) -> str:
    """<folder>/<table>, <folder>/<table>.<fmt>, or either with a prefix; the first that is there."""
    places = [f"{folder}/{prefix}{name}{ending}" for prefix in prefixes for ending in ("", f".{fmt}")]
    return next((p for p in places if exists(spark, p)), places[0])


def _unclosed(record: Column) -> Column:
    """Whether a record has an odd number of quotes, as both parts of one have that was cut at a line break."""
    return F.pmod(F.octet_length(record) - F.octet_length(F.replace(record, F.lit('"'), F.lit(""))), F.lit(2)) == 1


def _csv_rows(spark: SparkSession, path: str, schema: StructType, multi_line: bool) -> tuple[DataFrame, dict[str, Column], dict[str, Column]]:
    """The rows as texts, with the record of those that have too few or too many values; the typed columns; by reason, what is wrong."""
    options = {"header": True, "escape": '"', "enforceSchema": False, "columnNameOfCorruptRecord": "_corrupt_record", "multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    missing = [c for c in schema.names if c not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    texts = StructType([StructField(c, StringType()) for c in [*header, "_corrupt_record"]])
    # Without pruning, since a row would else be only as long as the columns that are read.
    rows = spark.read.schema(texts).options(**options, columnPruning=False).csv(path)
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields}
    record = F.col("_corrupt_record")
    wrong = {"line break in quotes": F.coalesce(_unclosed(record), F.lit(False)), "number of values": record.isNotNull()}
    for f in schema.fields:
        if f.dataType != StringType():
            wrong[f"value of {f.name}"] = F.col(f"`{f.name}`").isNotNull() & typed[f.name].isNull()
    return rows, typed, wrong


def _read_csv(spark: SparkSession, path: str, schema: StructType, keep_malformed: bool, multi_line: bool) -> DataFrame:
    """Columns by the names in the header, in any order; a file whose header differs from the first one's is refused.

    Values that are not what their column should be are NULL. With `keep_malformed` a last column says which rows have one,
    or have too many or too few values. A quoted value with a line break is read as one only with `multi_line`, which keeps files from being split
    over tasks; else its parts are malformed rows, and reading stops at them unless malformed rows are kept.
    """
    rows, typed, wrong = _csv_rows(spark, path, schema, multi_line)
    if keep_malformed:
        return rows.select(*[value.alias(name) for name, value in typed.items()], reduce(Column.__or__, wrong.values()).alias(MALFORMED))
    torn = F.concat(F.lit(f"{path} has quoted values with line breaks, read it with multi_line: "), F.col("_corrupt_record"))
    refused = F.when(wrong["line break in quotes"], F.raise_error(torn))
    return rows.where(refused.isNull()).select(*[value.alias(name) for name, value in typed.items()])


def malformed_records(
    spark: SparkSession, folder: str, name: str, schema: StructType, *, multi_line: bool = False, prefixes: Sequence[str] = ("",)
) -> DataFrame:
    """(table_name, file, record, reasons) for every row of a CSV table; rows without fault have no reasons. The record is as it was read, or, where only
    values are wrong, its values written anew."""
    rows, _, wrong = _csv_rows(spark, _stored_at(spark, folder, name, "csv", prefixes), schema, multi_line)
    values = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != "_corrupt_record"]))
    reasons = F.filter(F.array(*[F.when(broken, reason) for reason, broken in wrong.items()]), lambda r: r.isNotNull())
    return rows.select(
        F.lit(name).alias("table_name"), F.col("_metadata.file_path").alias("file"), F.coalesce("_corrupt_record", values).alias("record"), reasons.alias("reasons")
    )


def _read(
    spark: SparkSession, folder: str, schemas: Mapping[str, StructType], fmt: str, prefixes: Sequence[str], keep_malformed: bool = False,
    multi_line: bool = False,
) -> dict[str, DataFrame]:
    if fmt not in FORMATS:
        raise ValueError(f"expected one of {FORMATS}, not {fmt!r}")
    tables = {}
    for name, schema in schemas.items():
        path = _stored_at(spark, folder, name, fmt, prefixes)
        tables[name] = _read_csv(spark, path, schema, keep_malformed, multi_line) if fmt == "csv" else spark.read.schema(schema).parquet(path)
    return tables


def read_raw(
    spark: SparkSession, folder: str, fmt: str = "csv", *, keep_malformed: bool = False, multi_line: bool = False
) -> dict[str, DataFrame]:
    """The six raw tables; messy columns stay text, nothing is inferred."""
    return _read(spark, folder, RAW, fmt, ("",), keep_malformed, multi_line)


def read_clean(
    spark: SparkSession, folder: str, fmt: str = "parquet", *, keep_malformed: bool = False, multi_line: bool = False
) -> dict[str, DataFrame]:
    return _read(spark, folder, CLEAN, fmt, ("", "clean_"), keep_malformed, multi_line)


def write_clean(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    if fmt not in FORMATS:
        raise ValueError(f"expected one of {FORMATS}, not {fmt!r}")
    for name, df in tables.items():
        writer = df.select(CLEAN[name].names).write.mode("overwrite")
        if fmt == "csv":
            # Quotes are doubled and blanks around a value stay, which is what other readers expect.
            writer.options(**CSV_OUT).csv(f"{folder}/{name}")
        else:
            writer.parquet(f"{folder}/{name}")


def quality_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(check, subject, violations) of every key, reference and value rule."""
    keys = pk_violations(tables).select(
        F.lit("key").alias("check"), F.col("table_name").alias("subject"), (F.col("n_surplus_rows") + F.col("n_null_keys")).alias("violations")
    )
    references = fk_orphans(tables).select(
        F.lit("reference").alias("check"), F.concat_ws(".", "child_table", "fk_column").alias("subject"),
        F.col("n_orphans").alias("violations"),
    )
    values = domain_violations(tables).select(
        F.lit("value").alias("check"), F.concat_ws(": ", "table_name", "rule").alias("subject"),
        F.col("n_violations").alias("violations"),
    )
    return reduce(DataFrame.unionByName, (keys, references, values))


def publish_tables(tables: Mapping[str, DataFrame], database: str, *, buckets: int | None = None) -> None:
    """Replace the catalog tables, but only if every check of the whole set passes.

    Pass tables that are already written (read_clean): they are read by the checks and again by the load.
    With `buckets`, customers and usage are stored by customer, so that joins and windows on customer_id
    read them in place instead of shuffling them.
    """
    broken = quality_report(tables).where(F.col("violations") > 0).orderBy("check", "subject").take(20)
    if broken:
        found = "; ".join(f"{r['check']} {r['subject']}: {r['violations']}" for r in broken)
        raise ValueError(f"nothing published, checks failed: {found}")
    for name, df in tables.items():
        key = BUCKETED.get(name) if buckets else None
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key) if key else df.write
        writer.mode("overwrite").saveAsTable(f"{database}.{name}")


def publish_star(star: Mapping[str, DataFrame], folder: str) -> None:
    """Write the star tables as Parquet; the large facts by month, so that a month filter prunes files."""
    for name, df in star.items():
        if name in BY_MONTH:
            # Rows of one month come together first; REBALANCE splits a month that is too big for one file.
            df.hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(f"{folder}/{name}")
        else:
            df.write.mode("overwrite").parquet(f"{folder}/{name}")


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> DataFrame:
    """Register the clean tables and subscription_mrr as temporary views, their names after `prefix`; return the latter."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    mrr = subscription_mrr(tables["subscriptions"], tables["plans"])
    mrr.createOrReplaceTempView(f"{prefix}subscription_mrr")
    return mrr


def metrics_table(parts: Iterable[tuple[str, DataFrame]], log: DataFrame | None = None) -> DataFrame:
    """One long table (job, metric, value) from one-row results of named jobs, and a cleaning log if given."""

    def long(job: str, row: DataFrame) -> DataFrame:
        values = row.select(*[F.col(c).cast("double").alias(c) for c in row.columns])
        return values.unpivot([], values.columns, "metric", "value").select(F.lit(job).alias("job"), "metric", "value")

    tables = [long(job, row) for job, row in parts]
    if log is not None:
        metric = F.concat_ws(".", "table_name", "metric").alias("metric")
        tables.append(log.select(F.lit("cleaning").alias("job"), metric, F.col("value").cast("double").alias("value")))
    return reduce(DataFrame.unionByName, tables)


def write_metrics(metrics: DataFrame, folder: str, *, run: str) -> None:
    """Keep the metrics of a run beside those of earlier runs; writing a run again replaces it."""
    metrics.write.mode("overwrite").parquet(f"{folder}/run={run}")
