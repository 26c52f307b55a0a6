"""Tables compared by digest trees, joins of intervals, and mergeable sketches, each against a plain or exact version."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from tables import rows

from recurra.operators import compare, intervals, sketches

WIDE = "k bigint, j string, v int, w string"


def table(spark, cells):
    return spark.createDataFrame([(k, j, *v) for (k, j), v in cells.items()], WIDE).repartition(3)


@pytest.mark.parametrize("bits, step", [(16, 4), (3, 1), (8, 4)])
def test_differing_rows(spark, bits, step):
    random.seed(bits)
    left = {(i if i % 11 else None, f"j{i}" if i % 7 else None): (i % 5 or None, f"w{i}") for i in range(1, 400)}
    right = dict(left)
    for key in random.sample(sorted(left, key=repr), 12):
        kind = random.randrange(3)
        if kind == 0:
            del right[key]
        elif kind == 1:
            right[key] = (99, left[key][1])
        else:
            right[key] = (None, None)
    right[(10_000, "new")] = (1, "x")
    expected = []
    for key in {*left, *right}:
        if key not in right:
            expected.append((*key, "left_only", ""))
        elif key not in left:
            expected.append((*key, "right_only", ""))
        elif left[key] != right[key]:
            expected.append((*key, "diff", ",".join(c for c, a, b in zip("vw", left[key], right[key]) if a != b)))
    found = compare.differing_rows(table(spark, left), table(spark, right).select("w", "v", "j", "k"), ["k", "j"], bits=bits, step=step)
    assert sorted(rows(found), key=repr) == sorted(expected, key=repr)
    assert compare.differing_rows(table(spark, left), table(spark, left), ["k", "j"], bits=bits, step=step).count() == 0
    assert compare.differing_rows(table(spark, {}), table(spark, {}), ["k", "j"], bits=bits, step=step).count() == 0


def test_one_difference_in_a_million_rows_joins_one_bucket(spark):
    left = spark.range(1_000_000).selectExpr("id AS k", "id * 7 % 1000 AS v")
    right = left.withColumn("v", F.when(F.col("k") == 123_456, -1).otherwise(F.col("v")))
    trees = [compare.bucket_digests(side, ["k"]) for side in (left, right)]
    buckets = compare.differing_buckets(*trees)
    assert buckets.count() == 1
    assert rows(compare.differing_rows(left, right, ["k"])) == [(123_456, "diff", "v")]
    inside = left.withColumn("bucket", compare._bucket(["k"], compare.BUCKET_BITS)).join(buckets, "bucket").count()
    assert inside < 200


def test_other_columns_cannot_be_compared(spark):
    with pytest.raises(ValueError, match="different columns"):
        compare.differing_rows(spark.range(1), spark.range(1).toDF("x"), ["id"])


RANGES = "id int, a date, b date"


def ranges(spark, spans):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spans)], RANGES).repartition(3)


def nested_loop(left, right):
    return sorted((i, j) for i, (a, b) in enumerate(left) for j, (c, d) in enumerate(right) if None not in (a, b, c, d) and a <= b and c <= d and a <= d and c <= b)


def joined(spark, left, right, **options):
    found = intervals.overlap_join(ranges(spark, left), ranges(spark, right), left_range=("a", "b"), right_range=("a", "b"), **options)
    return sorted((r["left"]["id"], r["right"]["id"]) for r in found.collect()), found


def spans(n, longest, seed):
    random.seed(seed)
    zero = date(1969, 6, 1)
    found = []
    for _ in range(n):
        a = zero + timedelta(random.randrange(900))
        found.append((a, a + timedelta(int(longest ** random.random()) - 1)))
    return found


@pytest.mark.parametrize("longest", [1, 40, 20_000])
@pytest.mark.parametrize("hot_rows", [5, 100_000])
def test_overlaps_equal_the_nested_loop(spark, longest, hot_rows):
    left = [*spans(150, longest, 1), (None, date(2000, 1, 1)), (date(2000, 1, 2), date(2000, 1, 1)), (date(1, 1, 1), date(9999, 12, 31))]
    right = [*spans(150, 60, 2), *spans(10, 20_000, 3), (date(1970, 1, 1), None), right_same := (date(1970, 1, 1), date(1970, 1, 1)), right_same]
    found, plan = joined(spark, left, right, hot_rows=hot_rows)
    assert found == nested_loop(left, right)
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in shown and "NestedLoop" not in shown


def test_overlaps_of_nothing(spark):
    assert joined(spark, [], spans(5, 10, 1))[0] == [] and joined(spark, spans(5, 10, 1), [])[0] == []


def test_a_hot_bucket_is_split_and_long_intervals_cost_little(spark):
    day = date(2024, 5, 5)
    left = ranges(spark, [(day, day)] * 3_000)
    entered = intervals._entered(left, "a", "b", "left", 0).groupBy("level", "bucket").count()
    assert entered.count() == 1
    found, _ = joined(spark, [(day, day)] * 300, [(day, day)] * 3, hot_rows=10)
    assert len(found) == 900 and len(set(found)) == 900
    # An interval of a thousand years makes two entries at most for every level.
    wide = ranges(spark, [(date(1500, 1, 1), date(2500, 1, 1))])
    assert intervals._entered(wide, "a", "b", "left", 22).count() <= 2 * 23


def test_short_intervals_do_not_meet_in_wide_buckets(spark):
    left = [(date(2000, 1, 1) + timedelta(3 * i), date(2000, 1, 1) + timedelta(3 * i)) for i in range(300)]
    long = [(date(1990, 1, 1), date(2020, 1, 1))]
    found, plan = joined(spark, left, left + long)
    assert len(found) == 600


def test_distinct_sketches_merge(spark):
    data = spark.range(60_000).selectExpr("id % 7 AS month", "id % 3 AS segment", "CASE WHEN id % 50 = 0 THEN NULL ELSE (id * 2654435761) % 20011 END AS customer_id")
    monthly = sketches.distinct_sketches(data, ["month", "segment"], "customer_id")
    for chosen in ("month < 3", "segment = 1", "month >= 0"):
        exact = data.where(chosen).agg(F.countDistinct("customer_id")).first()[0]
        merged = sketches.distinct_counts(sketches.merged_distinct(monthly.where(chosen))).first()["approx_count"]
        whole = sketches.distinct_counts(sketches.distinct_sketches(data.where(chosen), [], "customer_id")).first()["approx_count"]
        assert abs(merged - exact) <= 4 * sketches.distinct_error() * exact
        assert abs(merged - whole) <= 0.02 * whole
    by_segment = sketches.distinct_counts(sketches.merged_distinct(monthly, ["segment"]))
    assert by_segment.count() == 3
    assert sketches.distinct_counts(sketches.merged_distinct(monthly.limit(0), ["segment"])).count() == 0


def test_quantile_sketches_merge(spark):
    random.seed(2)
    values = [(i % 5, random.choice([7, random.randrange(10**6), random.randrange(100)])) for i in range(30_000)]
    data = spark.createDataFrame(values + [(1, None)], "segment int, v bigint")
    stored = sketches.quantile_sketches(data, ["segment"], "v")
    assert stored.agg(F.sum("n")).first()[0] == 30_000
    shares = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]
    for chosen in ([0, 1, 2, 3, 4], [2], [0, 4]):
        own = sorted(v for s, v in values if s in chosen)
        merged = sketches.merged_quantiles(stored.where(F.col("segment").isin(chosen)))
        for share, value in rows(sketches.quantiles(merged, shares)):
            # Ranks that the value may stand for, against the rank asked for.
            low, high = sum(v < value for v in own) / len(own), sum(v <= value for v in own) / len(own)
            assert low - 0.03 <= share <= high + 0.03
    assert sketches.quantiles(sketches.merged_quantiles(stored, ["segment"]), [0.5]).columns == ["segment", "share", "value"]
