"""Two large tables compared by a tree of digests, so that only rows of buckets that differ are ever joined.

Every row has a bucket by its key. A bucket's digest does not depend on the order of rows, and a parent's is made of its children's. The
roots are compared first, then only children of parents that differ, down to buckets; equal tables cost one pass each and no join of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.operators.joins import lookup_join
from recurra.session import cut_lineage
from recurra.sources.publishing import digests_by, order_free_digest

# Leaves of the tree, and children of a node: 16 bits in steps of four.
BUCKET_BITS, STEP_BITS = 16, 4
_DIGEST = ("n_rows", "xor_hash", "sum_hash")


def _bucket(keys: Sequence[str], bits: int) -> Column:
    # A null key is a key like any other.
    parts = [c for k in keys for c in (F.col(k), F.col(k).isNull())]
    return F.pmod(F.xxhash64(F.lit("bucket"), *parts), F.lit(1 << bits)).cast("int")


def bucket_digests(table: DataFrame, keys: Sequence[str], *, bits: int = BUCKET_BITS) -> DataFrame:
    """(bucket, n_rows, xor_hash, sum_hash): the leaves of a table's tree. They may be stored, and compared without the table."""
    return digests_by(table.withColumn("bucket", _bucket(keys, bits)), "bucket")


def _parents(nodes: DataFrame, step: int) -> DataFrame:
    mixed = nodes.withColumn("_hash", F.xxhash64("bucket", *_DIGEST))
    return mixed.groupBy(F.shiftright("bucket", step).alias("bucket")).agg(*order_free_digest())


def differing_buckets(left: DataFrame, right: DataFrame, *, bits: int = BUCKET_BITS, step: int = STEP_BITS) -> DataFrame:
    """(bucket) of the leaves that differ, found from the root down; `left` and `right` are bucket digests."""
    levels = [(left, right)]
    for _ in range(0, bits, step):
        levels.append(tuple(_parents(side, step) for side in levels[-1]))
    found: DataFrame | None = None
    for mine, other in reversed(levels):
        if found is not None:
            under = found.select(F.col("bucket").alias("_parent"))
            mine, other = (
                side.join(under, F.shiftright(side["bucket"], step) == F.col("_parent"), "left_semi") for side in (mine, other)
            )
        theirs = other.select(F.col("bucket").alias("_bucket"), *[F.col(c).alias(f"_{c}") for c in _DIGEST])
        equal = reduce(Column.__and__, [F.coalesce(F.col(c) == F.col(f"_{c}"), F.lit(False)) for c in _DIGEST])
        both = mine.join(theirs, F.col("bucket") == F.col("_bucket"), "full").where(~equal)
        found = both.select(F.coalesce("bucket", "_bucket").alias("bucket"))
    assert found is not None
    return found


def differing_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], *, bits: int = BUCKET_BITS, step: int = STEP_BITS) -> DataFrame:
    """keys, status (left_only, right_only or diff) and `columns`, the names of those that differ, for every key that the tables disagree on.

    The tables have the same columns, and a key names one row of each; rows that repeat a key are compared with each other as pairs. Only rows of
    buckets that differ are joined. Nulls are values. Pass stored tables, since each is read for its digests and again for those rows.
    """
    if set(left.columns) != set(right.columns):
        raise ValueError("the tables have different columns")
    right = right.select(left.columns)
    trees = [cut_lineage(bucket_digests(side, keys, bits=bits)) for side in (left, right)]
    buckets = cut_lineage(differing_buckets(*trees, bits=bits, step=step))
    others = [c for c in left.columns if c not in keys]

    def narrowed(side: DataFrame, name: str) -> DataFrame:
        # At most 2^bits buckets: broadcast if a count shows that they are few.
        rows = lookup_join(side.withColumn("bucket", _bucket(keys, bits)), buckets, "bucket", "left_semi")
        return rows.select("bucket", *[F.col(k).alias(f"{name}_{k}") for k in keys], F.struct(*[F.col(c) for c in others]).alias(name), F.lit(True).alias(f"in_{name}"))

    mine, theirs = narrowed(left, "left"), narrowed(right, "right")
    # The bucket is part of the key, since a join on null-safe keys alone could not be placed by hash where all are null.
    on = [mine["bucket"] == theirs["bucket"], *[F.col(f"left_{k}").eqNullSafe(F.col(f"right_{k}")) for k in keys]]
    both = mine.join(theirs, reduce(Column.__and__, on), "full")
    differing = F.filter(
        F.array(*[F.when(~F.col("left")[c].eqNullSafe(F.col("right")[c]), F.lit(c)) for c in others]).cast("array<string>"), lambda c: c.isNotNull()
    )
    status = F.when(F.col("in_right").isNull(), "left_only").when(F.col("in_left").isNull(), "right_only").otherwise("diff")
    named = both.select(
        *[F.when(F.col("in_left"), F.col(f"left_{k}")).otherwise(F.col(f"right_{k}")).alias(k) for k in keys], status.alias("status"),
        F.when(F.col("in_left") & F.col("in_right"), differing).alias("columns"),
    )
    return named.where((F.col("status") != "diff") | (F.size("columns") > 0)).withColumn("columns", F.concat_ws(",", "columns"))
