"""Joins that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup of this many narrow rows takes a few megabytes on each executor.
LOOKUP_MAX_ROWS = 50_000
SALTS = 8


def lookup_join(fact: DataFrame, lookup: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join a fact to a lookup that is expected to be small, after counting whether it is.

    Up to LOOKUP_MAX_ROWS rows the lookup is broadcast and the fact is not shuffled at all, however few
    keys it has. A larger one goes through a shuffle join, where AQE splits the partitions of hot keys.
    """
    if lookup.limit(LOOKUP_MAX_ROWS + 1).count() <= LOOKUP_MAX_ROWS:
        lookup = F.broadcast(lookup)
    return fact.join(lookup, on, how)


def spread_join(
    big: DataFrame, small: DataFrame, on: str, spread_by: Sequence[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Join `big` to `small` (at most one row per key) with each key of `big` spread over `salts` tasks.

    The salt is a hash of row columns, not a random number, so a task that is run again after a lost
    executor sends its rows to the same place.
    """
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [on, "_salt"], how).drop("_salt")


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a global aggregate, which is one row by construction, to every row."""
    return df.crossJoin(F.broadcast(one_row))
