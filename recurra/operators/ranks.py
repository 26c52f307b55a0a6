"""Exact order statistics and histograms over whole-number values, without gathering them in one task.

Values travel as (value, copies): equal values are counted before they move, so a value that a third of the
rows share is a single row. A rank is found by narrowing: count per bucket of leading digits, keep the
bucket that holds the rank, look at all digits of the values in it. The bucket of a value depends on
nothing but the value, so a recomputed task agrees with the first one. Each step looks at five digits more at most
(four in the last), so what is ever ordered in one task is at most 10^5 buckets of a magnitude.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.operators.joins import with_scalar
from recurra.session import cut_lineage

# Leading digits looked at in turn; the last one covers every BIGINT whole.
NARROWING = (5, 10, 15, 19)
# For values from a small range (days, say) the values themselves are few enough.
FEW_VALUES = (19,)


def value_counts(values: DataFrame, column: str) -> DataFrame:
    """value, copies; written once to the shared folder, because every step below reads it again."""
    counts = (
        values.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("bigint").alias("value"))
        .agg(F.count("*").alias("copies"))
    )
    return cut_lineage(counts)


def _bucket(value: Column, digits: int) -> Column:
    """Magnitude and leading digits as one number that grows with the value."""
    if digits >= 19:
        return value
    size = F.length(F.abs(value).cast("string"))
    powers = F.array(*[F.lit(10**k).cast("bigint") for k in range(19)])

    def power(exponent: Column) -> Column:
        return F.get(powers, F.greatest(exponent, F.lit(0)))

    leading = F.call_function("div", F.abs(value), power(size - digits)) * power(digits - size)
    bucket = size.cast("bigint") * 10**digits + leading
    return F.when(value < 0, -bucket).when(value > 0, bucket).otherwise(F.lit(0)).cast("bigint")


def values_at(counts: DataFrame, ranks: DataFrame, narrowing: tuple[int, ...] = NARROWING) -> DataFrame:
    """`ranks` with the value at each 0-based `position`; its other columns stay as they are.

    `ranks` is a handful of rows made from a global aggregate, so it is broadcast. Every step reads the counts once and looks into the
    buckets that the step before has found, which are as many as there are ranks.
    """
    kept = [c for c in ranks.columns if c != "position"]
    left = counts.crossJoin(F.broadcast(ranks))
    for digits, finer in zip(narrowing, (*narrowing[1:], None)):
        sizes = left.groupBy(*kept, "position", _bucket(F.col("value"), digits).alias("bucket")).agg(F.sum("copies").alias("size"))
        before = Window.partitionBy(*kept).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        hit = (
            sizes.withColumn("below", F.coalesce(F.sum("size").over(before), F.lit(0)))
            .where((F.col("below") <= F.col("position")) & (F.col("position") < F.col("below") + F.col("size")))
            .select(*kept, "bucket", (F.col("position") - F.col("below")).alias("position"))
        )
        if finer is None:
            return hit.select(*kept, F.col("bucket").alias("value"))
        # A finer bucket lies in one coarser one, so the last hit says all that the earlier ones did.
        left = counts.join(F.broadcast(hit), _bucket(F.col("value"), digits) == F.col("bucket")).drop("bucket")
    raise ValueError("narrowing must not be empty")


def quantile_neighbours(counts: DataFrame, percent: int, narrowing: tuple[int, ...] = NARROWING) -> DataFrame:
    """One row: n, total, lowest, highest, the values around the quantile, and how far (in hundredths) it is between them."""
    whole = counts.agg(
        F.sum("copies").alias("n"), F.sum(F.col("value").cast("decimal(38,0)") * F.col("copies")).alias("total"),
        F.min("value").alias("lowest"), F.max("value").alias("highest"),
    ).where(F.col("n") > 0)
    carried = ["n", "total", "lowest", "highest", "hundredths"]
    scaled = (F.col("n") - 1) * percent
    place = whole.withColumn("at", F.call_function("div", scaled, F.lit(100))).withColumn(
        "hundredths", F.pmod(scaled, F.lit(100))
    )
    both = F.array(
        F.struct(F.lit("low").alias("rank_name"), F.col("at").alias("position")),
        F.struct(F.lit("high").alias("rank_name"), F.least(F.col("at") + 1, F.col("n") - 1).alias("position")),
    )
    found = values_at(counts, place.select(*carried, F.inline(both)), narrowing)
    return found.groupBy(*carried).agg(
        F.max(F.when(F.col("rank_name") == "low", F.col("value"))).alias("low"),
        F.max(F.when(F.col("rank_name") == "high", F.col("value"))).alias("high"),
    )


def median_and_mean(counts: DataFrame, narrowing: tuple[int, ...] = NARROWING) -> DataFrame:
    """One row: n, median2 (twice the median, so it is whole) and total."""
    # Half a step lies between the neighbours for an even count, none for an odd one.
    twice = F.when(F.col("hundredths") == 0, F.col("low") * 2).otherwise(F.col("low") + F.col("high"))
    return quantile_neighbours(counts, 50, narrowing).select("n", twice.alias("median2"), "total")


def bounds(counts: DataFrame) -> DataFrame:
    return counts.agg(F.min("value").alias("lowest"), F.max("value").alias("highest")).where(
        F.col("lowest").isNotNull()
    )


def equal_width_bins(counts: DataFrame, limits: DataFrame, bins: int, unit: Column, value: Column | None = None) -> DataFrame:
    """bin (1 to `bins`), bin_low, bin_high, n; the last bin is closed, empty bins are kept.

    `limits` is one row with lowest and highest; `value` may be an expression over it and the counts.
    `unit` is what one unit of the values is worth on the histogram's axis, as a divisor.
    """
    value = F.col("value") if value is None else value
    width = F.col("highest") - F.col("lowest")
    place = F.call_function("div", (value - F.col("lowest")) * bins, F.greatest(width, F.lit(1))) + 1
    filled = (
        with_scalar(counts, limits)
        .groupBy("lowest", "highest", F.least(place, F.lit(bins)).cast("int").alias("bin"))
        .agg(F.sum("copies").alias("n"))
    )
    # At most `bins` entries.
    heights = filled.groupBy("lowest", "highest").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("heights")
    )
    every = heights.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))

    def edge(step: Column) -> Column:
        return (F.col("lowest") * bins + width * step).cast("double") / bins / unit

    return every.select(
        "bin", edge(F.col("bin") - 1).alias("bin_low"), edge(F.col("bin")).alias("bin_high"),
        F.coalesce(F.try_element_at("heights", F.col("bin")), F.lit(0)).alias("n"),
    )
