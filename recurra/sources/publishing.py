"""Reloads that readers see whole or not at all, and reloads of the months that changed."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.schemas import CLEAN
from recurra.sources.files import names_in, read_text, removed, replace_text
from recurra.sources.tables import quality_report, write_clean

CURRENT = "current"
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def _runs(folder: str) -> str:
    return f"{folder}/runs"


def publish_run(tables: Mapping[str, DataFrame], folder: str, *, run: str) -> None:
    """Load all tables under the name of a run, check what was written, and only then make it what readers of the folder get.

    The switch is one renamed file, so readers have all tables of one run, whatever fails and whenever; a run that failed leaves only a folder that no
    reader looks at and that the same run replaces. The run that readers have is never loaded again.
    """
    if not _NAME.fullmatch(run):
        raise ValueError(f"{run!r} is no name of a run")
    spark = next(iter(tables.values())).sparkSession
    if current_run(spark, folder) == run:
        raise ValueError(f"{run!r} is what readers have already")
    place = f"{_runs(folder)}/{run}"
    removed(spark, place)
    write_clean(tables, place)
    written = {name: spark.read.schema(CLEAN[name]).parquet(f"{place}/{name}") for name in tables}
    broken = quality_report(written).where(F.col("violations") > 0).orderBy("check", "subject").take(20)
    if broken:
        found = "; ".join(f"{r['check']} {r['subject']}: {r['violations']}" for r in broken)
        raise ValueError(f"{run} not published, checks failed: {found}")
    replace_text(spark, f"{folder}/{CURRENT}", json.dumps({"run": run, "tables": sorted(tables)}), part=run)


def _current(spark: SparkSession, folder: str) -> dict | None:
    line = read_text(spark, f"{folder}/{CURRENT}")
    return json.loads(line) if line else None


def current_run(spark: SparkSession, folder: str) -> str | None:
    found = _current(spark, folder)
    return found["run"] if found else None


def read_published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the run that was switched to last; they stay that run's, whatever is published after."""
    found = _current(spark, folder)
    if found is None:
        raise ValueError(f"nothing is published in {folder}")
    return {name: spark.read.schema(CLEAN[name]).parquet(f"{_runs(folder)}/{found['run']}/{name}") for name in found["tables"]}


def drop_old_runs(spark: SparkSession, folder: str, *, keep: int = 1) -> list[str]:
    """Delete all runs but the current one and the `keep` last others by name; their names. Readers may still be in the ones that go."""
    now = current_run(spark, folder)
    others = [run for run in names_in(spark, _runs(folder)) if run != now]
    gone = others[: len(others) - keep] if keep else others
    for run in gone:
        removed(spark, f"{_runs(folder)}/{run}")
    return gone


def row_hash(df: DataFrame) -> Column:
    """64 bits of a whole row; a null differs from every value and from a null in another column."""
    return F.xxhash64(*[c for name in df.columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())])


def order_free_digest(hashed: str = "_hash") -> list[Column]:
    """Rows, xor and sum of their hashes: the same in any order, and other for a row more, less, repeated or changed."""
    halves = F.shiftrightunsigned(hashed, 32) + F.col(hashed).bitwiseAND(0xFFFFFFFF) * 3
    return [F.count("*").alias("n_rows"), F.bit_xor(hashed).alias("xor_hash"), F.sum(halves.cast("decimal(20,0)")).cast("decimal(38,0)").alias("sum_hash")]


def digests_by(df: DataFrame, *keys: str) -> DataFrame:
    """`keys`, n_rows, xor_hash, sum_hash; a row a key and task moves."""
    return df.withColumn("_hash", row_hash(df)).groupBy(*keys).agg(*order_free_digest())


_DIGEST = ("n_rows", "xor_hash", "sum_hash")


def refresh_by_month(table: DataFrame, folder: str, *, month: str = "month") -> DataFrame:
    """Bring a table stored by month up to date and return what was done to each month: (month, status, n_rows).

    Status is same, rewritten, added or removed. Digests of the months are stored beside the data, so an unchanged month is neither read
    nor written. Digests of months that will change are taken away before the data are touched: if the job dies, the next one writes those
    months again. Pass a stored table, since it is read for the digests and again for what changed. A null month is a month.
    """
    spark = table.sparkSession
    kind = table.schema[month].dataType
    data, beside = f"{folder}/data", f"{folder}/digests"
    new = digests_by(table, month)
    schema = new.schema
    stored = spark.read.schema(schema).parquet(beside) if names_in(spark, beside) else spark.createDataFrame([], schema)
    old = stored.select(F.col(month).alias("_month"), *[F.col(c).alias(f"old_{c}") for c in _DIGEST])
    both = new.join(old, F.col(month).eqNullSafe(F.col("_month")), "full")
    same = F.lit(True)
    for c in _DIGEST:
        same = same & (F.col(c) == F.col(f"old_{c}"))
    status = F.when(F.col("old_n_rows").isNull(), "added").when(F.col("n_rows").isNull(), "removed").when(same, "same").otherwise("rewritten")
    # One row a month.
    rows = both.select(
        F.when(F.col("n_rows").isNull(), F.col("_month")).otherwise(F.col(month)).alias(month), status.alias("status"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"), *_DIGEST[1:], F.col("old_n_rows"), F.col("old_xor_hash"), F.col("old_sum_hash"),
    ).collect()
    changed = [r[month] for r in rows if r["status"] != "same"]
    if changed:
        def written(kept: list[tuple]) -> None:
            replace_folder(spark.createDataFrame(kept, schema).coalesce(1), beside)

        written([(r[month], r["old_n_rows"], r["old_xor_hash"], r["old_sum_hash"]) for r in rows if r["status"] == "same"])
        for r in rows:
            if r["status"] == "removed":
                removed(spark, f"{data}/{month}={'__HIVE_DEFAULT_PARTITION__' if r[month] is None else r[month]}")
        loaded = [r[month] for r in rows if r["status"] in ("added", "rewritten")]
        if loaded:
            wanted = F.col(month).isin([m for m in loaded if m is not None])
            if None in loaded:
                wanted = F.coalesce(wanted, F.lit(False)) | F.col(month).isNull()
            pieces = table.where(wanted).hint("rebalance", month)
            pieces.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(data)
        written([(r[month], r["n_rows"], r["xor_hash"], r["sum_hash"]) for r in rows if r["status"] != "removed"])
    done = [(r[month], r["status"], r["n_rows"]) for r in rows]
    return spark.createDataFrame(done, f"{month} {kind.simpleString()}, status string, n_rows bigint")


def replace_folder(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
