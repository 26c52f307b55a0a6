"""Joins of intervals that overlap, as equality joins on time buckets.

Bucket widths double from level to level, and an interval belongs to the lowest level whose width is at least its length, so there it lies in
two buckets at most, however long it is. It is also entered in the buckets of all higher levels in use, two at most of each, where it meets the
other side's intervals of that level and no others: short intervals never meet each other in a wide bucket. So a pair meets on the level
of its longer interval, and counts there only in the bucket in which the later one of the two begins. Buckets that hold many
rows are split: the left rows are dealt out, the right ones go to every part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.operators.joins import lookup_join
from recurra.session import cut_lineage

# Left rows of a bucket that one task takes.
HOT_ROWS = 100_000


def _level(days: Column) -> Column:
    """The lowest level whose width is at least `days`."""
    return F.when(days <= 1, 0).otherwise(F.length(F.bin(days - 1))).cast("int")


def _bucket(day: Column, level: Column) -> Column:
    return F.call_function("shiftright", day, level)


def _entered(side: DataFrame, start: str, end: str, name: str, high: int) -> DataFrame:
    """The row as `name`, its days `from` and `to`, whether the entry is `own`, (level, bucket) for its own level and all above up to `high`."""
    day = F.unix_date(F.col(start)).cast("bigint"), F.unix_date(F.col(end)).cast("bigint")
    rows = side.select(F.struct(*[F.col(f"`{c}`") for c in side.columns]).alias(name), day[0].alias(f"{name}_from"), day[1].alias(f"{name}_to"))
    rows = rows.where(F.col(f"{name}_from") <= F.col(f"{name}_to"))
    lowest = _level(F.col(f"{name}_to") - F.col(f"{name}_from") + 1)
    levels = rows.withColumn("_lowest", lowest).where(F.col("_lowest") <= high).withColumn("level", F.explode(F.sequence(F.col("_lowest"), F.lit(high))))
    first, last = _bucket(F.col(f"{name}_from"), F.col("level")), _bucket(F.col(f"{name}_to"), F.col("level"))
    own = (F.col("level") == F.col("_lowest")).alias("own")
    return levels.select(name, f"{name}_from", f"{name}_to", "level", own, F.explode(F.array_distinct(F.array(first, last))).alias("bucket"))


def _highest_level(side: DataFrame, start: str, end: str) -> int:
    """The highest level of a side's intervals: one number."""
    days = F.datediff(F.col(end), F.col(start)) + 1
    return side.where(days > 0).agg(F.max(_level(days))).first()[0] or 0


def overlap_join(
    left: DataFrame, right: DataFrame, *, left_range: tuple[str, str], right_range: tuple[str, str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(left, right): every pair of rows whose ranges of dates have a day in common, each pair of rows once.

    Ranges have both ends; ranges without one, or that end before they begin, overlap nothing. Rows that repeat are rows. The result is as large as
    there are pairs; nothing else is: an interval makes at most two entries for each level in use.
    """
    high = max(_highest_level(left, *left_range), _highest_level(right, *right_range))
    # Side 0: left rows of the level meet right ones of it and of lower levels. Side 1: left rows of lower levels meet right ones of it.
    mine = _entered(left, *left_range, "left", high).withColumn("side", F.when(F.col("own"), 0).otherwise(1)).drop("own")
    sides = F.when(F.col("own"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    theirs = _entered(right, *right_range, "right", high).withColumn("side", F.explode(sides)).drop("own")
    place = ["level", "bucket", "side"]
    loads = cut_lineage(mine.groupBy(*place).agg(F.count("*").alias("n")).where(F.col("n") > hot_rows))
    parts = F.call_function("div", F.col("n") + hot_rows - 1, F.lit(hot_rows)).cast("int")
    hot = loads.select(*place, parts.alias("parts"))
    split = F.coalesce("parts", F.lit(1))
    # A part by the row's content, so a task that runs again deals it the same way.
    mine = lookup_join(mine, hot, place, "left").withColumn("part", F.pmod(F.xxhash64("left"), split).cast("int")).drop("parts")
    theirs = lookup_join(theirs, hot, place, "left").withColumn("part", F.explode(F.sequence(F.lit(0), split - 1))).drop("parts")
    met = mine.join(theirs, [*place, "part"])
    overlap = (F.col("left_from") <= F.col("right_to")) & (F.col("right_from") <= F.col("left_to"))
    begins = _bucket(F.greatest("left_from", "right_from"), F.col("level")) == F.col("bucket")
    return met.where(overlap & begins).select("left", "right")
