"""Mixing sources to target weights: whole copies first, then a subset of documents whose sizes add up to the rest.

The rest is fitted on counts of documents by exact size, so what one task handles for a source grows with the number of
different sizes, not with its documents: of every size the proportional share is taken, what is missing is filled with the
largest sizes that fit, and the last part is fitted by a bounded knapsack over the counts that are left. Which documents of a
size are taken is decided by a seeded hash of their ids, so reruns agree.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.llm.common import count_spaced_words, packed, without
from recurra.session import cut_lineage

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_COPIES = 2
SEED = 20
# Words that the knapsack fits exactly; its table has this many bits for each size.
KNAPSACK = 1 << 14
# Bits that the knapsack over a whole rest may take; a rest that needs more is fitted in units of several words.
KNAPSACK_BITS = 1 << 28
# Documents of one source and size that are put in order together.
RANKED_TOGETHER = 4096


def reachable(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each size come nearest to `budget` from below: a bounded knapsack whose values are its weights.

    A set of reachable sums is one whole number, bit i for sum i. Counts are split in powers of two, so that a shift adds a bundle.
    """
    bundles: list[tuple[int, int]] = []
    for place, (size, count) in enumerate(zip(sizes, counts)):
        left, bundle = min(count, budget // size), 1
        while left:
            bundles.append((place, min(bundle, left)))
            left -= bundles[-1][1]
            bundle *= 2
    window = (1 << (budget + 1)) - 1
    sums = [1]
    for place, bundle in bundles:
        sums.append(sums[-1] | (sums[-1] << (sizes[place] * bundle)) & window)
        if sums[-1] >> budget & 1:
            break
    taken = [0] * len(sizes)
    rest = sums[-1].bit_length() - 1
    for step in range(len(sums) - 1, 0, -1):
        if not sums[step - 1] >> rest & 1:
            place, bundle = bundles[step - 1]
            taken[place] += bundle
            rest -= sizes[place] * bundle
    return taken


def _whole_rest(sizes: list[int], counts: list[int], budget: int, bits: int) -> list[int]:
    """How many of each size come near `budget` from below, over all of it: by the knapsack, in units as fine as `bits` allow.

    Sizes are rounded up to units, so no sum is above the budget. A common divisor of the sizes costs nothing.
    """
    divisor = math.gcd(*sizes)
    bundles = sum(min(count, budget // size).bit_length() for size, count in zip(sizes, counts))
    unit = max(1, -(-(bundles * (budget // divisor)) // bits)) * divisor
    return reachable([-(-size // unit) for size in sizes], counts, budget // unit)


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int, knapsack: int = KNAPSACK, bits: int = KNAPSACK_BITS) -> np.ndarray:
    """How many documents of each size to take so that their sizes add up to `budget` as nearly as this finds, never above.

    Of every size the proportional share, then the largest that fit down to what the knapsack takes over. Where that leaves something, as it may
    with few and very long documents, the knapsack over all that the shares left is tried as well, and the nearer of both is taken.
    """
    taken = np.zeros(len(sizes), np.int64)
    total = sum(int(s) * int(c) for s, c in zip(sizes, counts))
    if not total or budget <= 0:
        return taken
    budget = min(budget, total)
    order = np.argsort(-sizes, kind="stable")
    left = budget
    for i in order:
        if sizes[i] > 0:
            taken[i] = int(counts[i]) * budget // total
            left -= int(taken[i]) * int(sizes[i])
    filled, rest = _filled(sizes, counts, taken, left, order, knapsack)
    if rest and left > knapsack:
        for start, gap in ((taken, left), (np.zeros_like(taken), budget)):
            open_ = [i for i in order[::-1] if 0 < sizes[i] <= gap and counts[i] > start[i]]
            if not open_:
                continue
            other = start.copy()
            other[open_] += _whole_rest([int(sizes[i]) for i in open_], [int(counts[i] - start[i]) for i in open_], gap, bits)
            # What rounding to units left over.
            other, missing = _filled(sizes, counts, other, budget - int((other * sizes).sum()), order, knapsack)
            if missing < rest:
                filled, rest = other, missing
    return filled


def _filled(sizes: np.ndarray, counts: np.ndarray, taken: np.ndarray, left: int, order: np.ndarray, knapsack: int) -> tuple[np.ndarray, int]:
    """`taken` with the largest sizes that fit into what is left, the last of it by the knapsack; and what is left then."""
    taken = taken.copy()
    for i in order:
        # The largest sizes fill the gap down to what the knapsack takes over.
        if sizes[i] > 0 and left > knapsack:
            more = min(int(counts[i] - taken[i]), (left - knapsack + int(sizes[i]) - 1) // int(sizes[i]), left // int(sizes[i]))
            taken[i] += more
            left -= more * int(sizes[i])
    open_ = [i for i in order[::-1] if 0 < sizes[i] <= left and counts[i] > taken[i]]
    if left <= knapsack and open_:
        found = reachable([int(sizes[i]) for i in open_], [int(counts[i] - taken[i]) for i in open_], left)
        taken[open_] += found
        left -= sum(n * int(sizes[i]) for n, i in zip(found, open_))
    else:
        for i in order:
            if 0 < sizes[i] <= left:
                more = min(int(counts[i] - taken[i]), left // int(sizes[i]))
                taken[i] += more
                left -= more * int(sizes[i])
    return taken, left


def numbered(sources: DataFrame) -> DataFrame:
    """`sources` with `place`, the 0-based number of each row by code point, null last; no task sees all of them."""
    by = [F.col("source").isNull(), F.col("source")]
    parted = cut_lineage(sources.repartitionByRange(*by).withColumn("part", F.spark_partition_id()))
    # One row for each partition.
    sizes = sorted((r["part"], r["count"]) for r in parted.groupBy("part").count().collect())
    before, offsets = 0, []
    for part, count in sizes:
        offsets += [F.lit(part), F.lit(before)]
        before += count
    own = F.row_number().over(Window.partitionBy("part").orderBy(*by)) - 1
    if not offsets:
        return parted.select("source", "source_size", F.lit(0).cast("bigint").alias("place"))
    return parted.select("source", "source_size", (own + F.create_map(*offsets)[F.col("part")]).cast("bigint").alias("place"))


def with_targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, most_copies: int = MOST_COPIES
) -> DataFrame:
    """(source, source_size) with `target`: the share of all sizes by repeating weights, stopped at `most_copies` times the size.

    What is above a stop is shared out anew among the sources below theirs, until no target is above its stop. The shares are
    always one rate times the weight, and the rate only grows, so each round is one small aggregate.
    """
    weight = reduce(lambda c, w: c.when(F.pmod("place", F.lit(len(weights))) == w[0], F.lit(w[1])), enumerate(weights), F)
    rows = cut_lineage(numbered(sources).withColumn("weight", weight.cast("double")))
    stop = F.col("source_size").cast("double") * most_copies
    budget = float(rows.agg(F.sum("source_size")).first()[0] or 0) * share_percent / 100
    rate, open_before = 0.0, -1
    while True:
        stopped = stop <= F.col("weight") * rate if rate else F.col("source_size") <= 0
        found = rows.agg(
            F.coalesce(F.sum(F.when(stopped, stop)), F.lit(0.0)).alias("used"),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0.0)).alias("open"),
            F.count(F.when(~stopped, 1)).alias("n"),
        ).first()
        if not found["n"] or found["n"] == open_before:
            break
        open_before = found["n"]
        rate = max(rate, (budget - found["used"]) / found["open"])
    return rows.select("source", "source_size", F.least(stop, F.col("weight") * rate).alias("target"))


def plan_counts(sized: DataFrame, targets: DataFrame, knapsack: int = KNAPSACK) -> DataFrame:
    """(source, size, n, source_size, target, copies, picked) for every source and size: every document comes `copies` times
    and `picked` of the n documents once more. One task handles the counts by size of one source."""
    by_size = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    goals = targets.select(
        F.col("source").alias("goal_of"), "source_size", "target",
        F.least(F.floor(F.col("target") / F.greatest("source_size", F.lit(1))), F.lit(MOST_COPIES)).cast("bigint").alias("copies"),
    )
    rest = (F.round("target") - F.col("copies") * F.col("source_size")).cast("bigint").alias("rest")
    histogram = by_size.join(goals, F.col("source").eqNullSafe(F.col("goal_of"))).select(
        "source", "size", "n", "source_size", "target", "copies", rest
    )

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        picked = fit_counts(group["size"].to_numpy(), group["n"].to_numpy(), int(group["rest"].iloc[0]), knapsack)
        return group.drop(columns="rest").assign(picked=picked)

    kind = sized.schema["source"].dataType.simpleString()
    return histogram.groupBy("source").applyInPandas(
        fitted, f"source {kind}, size bigint, n bigint, source_size bigint, target double, copies bigint, picked bigint"
    )


def _decided(sized: DataFrame, plan: DataFrame, seed: int, ranked_together: int) -> DataFrame:
    """`sized` with its plan and `chosen`, 1 for the documents that are picked. Documents of one source and size are put in
    order in runs of about `ranked_together`, dealt out by their hash; of one run only the first few may be in."""
    planned = plan.select(
        F.col("source").alias("p_source"), F.col("size").alias("p_size"), "n", "source_size", "target", "copies", "picked"
    )
    hashed = F.xxhash64(F.lit(seed), F.col("id").cast("string"), "text_hash")
    run = F.pmod(F.xxhash64(F.lit("run"), "hash"), F.ceil(F.col("n") / ranked_together).cast("bigint"))
    dealt = (
        sized.withColumn("hash", hashed)
        .join(planned, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")))
        .withColumn("run", run)
    )
    group = ["p_source", "p_size", "run"]
    before = Window.partitionBy("p_source", "p_size").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    rooms = (
        dealt.groupBy(*group).agg(F.count("*").alias("here"), F.first("picked").alias("wanted"))
        .select(
            F.col("p_source").alias("r_source"), F.col("p_size").alias("r_size"), F.col("run").alias("r_run"),
            (F.col("wanted") - F.coalesce(F.sum("here").over(before), F.lit(0))).alias("room"),
        )
    )
    turn = F.row_number().over(Window.partitionBy(*group).orderBy("hash", "id", "text_hash"))
    same = F.col("p_source").eqNullSafe(F.col("r_source")) & (F.col("p_size") == F.col("r_size")) & (F.col("run") == F.col("r_run"))
    chosen = F.when(F.col("turn") <= F.col("room"), 1).otherwise(0).cast("bigint")
    return dealt.withColumn("turn", turn).join(rooms, same).withColumn("chosen", chosen)


def _text_hash(id_column: str, text_column: str) -> Column:
    """What tells rows without an id apart; null for all others."""
    return F.when(F.col(id_column).isNull(), F.xxhash64(F.col(text_column)))


def _mixed(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, seed: int = SEED,
    knapsack: int = KNAPSACK, ranked_together: int = RANKED_TOGETHER,
) -> DataFrame:
    """As mix, with the columns named id and source, and text_hash."""
    sized = cut_lineage(docs.select(
        F.col(id_column).alias("id"), F.col(source_column).alias("source"), count_spaced_words(F.col(text_column)).alias("size"),
        _text_hash(id_column, text_column).alias("text_hash"),
    ))
    targets = with_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share_percent)
    plan = cut_lineage(plan_counts(sized, targets, knapsack))
    copies = F.col("copies") + F.col("chosen")
    return _decided(sized, plan, seed, ranked_together).select(
        "id", "source", "size", "text_hash", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken")
    )


def mix(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **options
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) for every row; `taken` is size times copies.

    Size is the number of blank-separated words, 0 for null texts. A null source is a source of its own, after all others. Every
    source's words come as near below its target as whole copies (two at most) and a fitted subset get; a source without words
    has target 0. Documents of one source and size are picked in the order of a hash of seed and id; rows without an id go by their texts. Rows that
    share id, source and size are alike. A very long text is one size, as any other. Extra columns are not read. No rows: no rows.
    """
    found = _mixed(docs, id_column=id_column, text_column=text_column, source_column=source_column, **options)
    return found.select(F.col("id").alias(id_column), F.col("source").alias(source_column), "size", "source_size", "target", "copies", "taken")


def mixed_rows(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **options) -> DataFrame:
    """The rows of `docs` that the mix has at least once, with all their columns and `mix` (size, target, copies, taken).

    A row stands for all its copies; whoever reads the mix repeats it `mix.copies` times. A column of `docs` named mix is
    replaced. Empty documents have no words to take and are left out.
    """
    found = _mixed(docs, id_column=id_column, text_column=text_column, source_column=source_column, **options)
    decisions = found.select(F.struct("id", "source", "size", "text_hash").alias("of"), "target", "copies", "taken")
    # Rows that share id, source and size get their decisions in any order, so those are kept as a list: as long as the repeats.
    decisions = decisions.where("taken > 0").groupBy("of").agg(F.sort_array(F.collect_list(F.struct("copies", "taken", "target")), False).alias("all"))
    mine = F.struct(
        F.col(id_column).alias("id"), F.col(source_column).alias("source"), count_spaced_words(F.col(text_column)).alias("size"),
        _text_hash(id_column, text_column).alias("text_hash"),
    )
    # Names are compared without case, as Spark does.
    here = without(docs, *[name for name in docs.columns if name.lower() == "mix"])
    rows = here.select(packed(here), mine.alias("key")).join(decisions, F.col("key") == F.col("of"))
    turn = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    return rows.withColumn("turn", turn).where(F.col("turn") <= F.size("all")).select(
        "row.*", F.struct(
            F.col("key.size").alias("size"), F.get("all", F.col("turn") - 1)["target"].alias("target"),
            F.get("all", F.col("turn") - 1)["copies"].alias("copies"), F.get("all", F.col("turn") - 1)["taken"].alias("taken"),
        ).alias("mix"),
    )
