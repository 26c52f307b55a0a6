"""Exact quantiles and histograms against sorted Python lists."""

from __future__ import annotations

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F
from tables import rows

from recurra.operators import ranks

RNG = random.Random(11)
SAMPLES = {
    "one": [42],
    "two": [1, 1_000_000],
    "hot value": [29_000_000] * 400 + [RNG.randrange(10**9) for _ in range(800)],
    "negative": [RNG.randrange(-(10**6), 10**6) for _ in range(501)] + [0, -1, 1],
    "many magnitudes": [int(10 ** RNG.uniform(0, 14)) for _ in range(1000)],
    "same leading digits": [123_456_000_000 + RNG.randrange(1000) for _ in range(300)],
}


def counted(spark, values):
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "x bigint")
    return ranks.value_counts(frame, "x")


@pytest.mark.parametrize("name", SAMPLES)
def test_median_and_mean(spark, name):
    values = SAMPLES[name]
    n, median2, total = rows(ranks.median_and_mean(counted(spark, values)))[0]
    assert (n, int(total)) == (len(values), sum(values))
    assert median2 / 2 == statistics.median(values)


@pytest.mark.parametrize("percent", [0, 1, 50, 99, 100])
def test_quantile_neighbours(spark, percent):
    values = sorted(SAMPLES["many magnitudes"])
    found = ranks.quantile_neighbours(counted(spark, values), percent)
    n, hundredths, low, high = rows(found.select("n", "hundredths", "low", "high"))[0]
    place = (n - 1) * percent
    assert (low, hundredths) == (values[place // 100], place % 100)
    assert high == values[min(place // 100 + 1, n - 1)]


def test_narrow_values_skip_the_first_step(spark):
    values = [RNG.randrange(3000) for _ in range(999)]
    assert rows(ranks.median_and_mean(counted(spark, values), ranks.FEW_VALUES))[0][1] / 2 == statistics.median(values)


@pytest.mark.parametrize("name", ["two", "negative", "hot value"])
def test_histogram(spark, name):
    values = SAMPLES[name]
    counts = counted(spark, values)
    found = sorted(rows(ranks.equal_width_bins(counts, ranks.bounds(counts), 30, F.lit(1.0))))
    heights, edges = np.histogram(values, bins=30)
    assert [n for *_, n in found] == heights.tolist()
    assert [low for _, low, *_ in found] == pytest.approx(edges[:-1].tolist())


def test_a_histogram_of_one_value(spark):
    counts = counted(spark, [5, 5, 5])
    found = sorted(rows(ranks.equal_width_bins(counts, ranks.bounds(counts), 4, F.lit(1.0))))
    assert [n for *_, n in found] == [3, 0, 0, 0]


def test_nothing_to_rank(spark):
    assert rows(ranks.median_and_mean(counted(spark, []))) == []
