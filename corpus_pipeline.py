"""Documents to a training mix in five stages; each works on all that the one before it kept.

Stages are written as Parquet and read again, so that a stage reads its input as often as it likes and a lost executor costs no
more than the stage it was in. All stages but the last return the columns of documents. Where a stage changes a text, `n_chars`
(if there is one) is counted anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm import decontamination, line_dedup, mixing, quality, simhash
from recurra.llm.common import read_table
from recurra.session import shared_dir
from recurra.sources.files import removed

# One stage cannot be told in SQL without XXH64, another is a knapsack: tests hold each against brute force.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or look like rejected text go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document, or an earlier place of the same one, has go; documents of nothing else go with them."""
    return _counted(line_dedup.without_repeated_lines(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays."""
    return simhash.one_of_each_component(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts; documents of nothing else go."""
    return _counted(decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with size, target, copies and taken words in the column mix."""
    return mixing.mixed_rows(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, written one after the other below the shared folder of the session."""
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if number:
            # Nothing reads the stage before any more.
            removed(spark, f"{folder}/{number - 1}")
    return docs
