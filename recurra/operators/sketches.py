"""Distinct counts and quantiles from sketches that are stored once and merged over any months and segments.

The exact operators stay what the reports use. A sketch has a fixed size, whatever it has seen, so one a month and segment is kept, and a question
over a range merges those instead of reading the rows again. Distinct counts are HyperLogLog (relative standard error about 1.04 / sqrt(2^lg_k)),
quantiles KLL (rank error about 1.33 % for k = 200).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
KLL_K = 200


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(rows: DataFrame, by: Sequence[str], value: str, *, lg_k: int = LG_K) -> DataFrame:
    """`by` and sketch: one for every group, made inside the tasks before anything moves. Null values are not counted."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(value, lg_k).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of unions: of all rows of each group of `by`. A merged sketch is as good as one made of the rows."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_counts(sketches: DataFrame) -> DataFrame:
    """The sketches' estimates in their place, as `approx_count`."""
    return sketches.withColumn("approx_count", F.hll_sketch_estimate("sketch")).drop("sketch")


def quantile_sketches(rows: DataFrame, by: Sequence[str], value: str, *, k: int = KLL_K) -> DataFrame:
    """`by`, n and sketch of a whole-number column; null values are not counted."""
    present = rows.where(F.col(value).isNotNull()).withColumn("_value", F.col(value).cast("bigint"))
    return present.groupBy(*by).agg(F.count("*").alias("n"), F.kll_sketch_agg_bigint("_value", k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of unions: of all rows of each group of `by`."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """One row for each share (0 to 1) in the sketches' place: share, value."""
    found = F.kll_sketch_get_quantile_bigint("sketch", F.array(*[F.lit(float(s)) for s in shares]))
    pairs = F.arrays_zip(F.array(*[F.lit(float(s)) for s in shares]).alias("share"), found.alias("value"))
    kept = [c for c in sketches.columns if c not in ("n", "sketch")]
    return sketches.select(*kept, F.inline(pairs).alias("share", "value"))
