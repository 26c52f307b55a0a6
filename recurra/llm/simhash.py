"""SimHash near-duplicates: fingerprints of word shingles, candidates by pigeonring filtering, components of linked fingerprints.

A fingerprint of 64 bits is cut into a ring of equal segments. If two fingerprints differ in at most `max_bits` bits, then from
some segment on every chain of consecutive segments of length l differs in at most l * max_bits / segments bits (the budgets
are proportional to the length). Whole numbers make this sharp: with 8 segments and 3 bits the first two segments of the
chain are equal and the next three differ in at most one bit, so at least two of those three are equal as well. Equality is
what a shuffle can join on: every distinct fingerprint is dealt out under one key for each start and each choice of the
segment that may differ. Fingerprints that share a key are compared chain by chain and then bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recurra.llm.common import packed, word_pieces
from recurra.llm.components import connected_components
from recurra.session import cut_lineage

HASH_SEED = 42
# Fingerprints that one task compares with each other; a key that has more of them is dealt out in pairs of blocks.
BLOCK = 2048
# Up to this many under one key, all comparisons of a batch are made together.
FEW = 8


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits. Eight counters of a byte share a word, so up to 255 rows are added at once."""
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").view(np.uint64).reshape(-1, 8)
    sums = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
    return sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, shingle_words: int = 3) -> int:
    """Bit by bit the majority of the shingles' hashes; zero for a text without words."""
    ones, total = np.zeros(64, np.int64), 0
    last: list[bytes] = []
    for words in word_pieces(text.lower()):
        words = last + words
        last = words[len(words) - shingle_words + 1:] if shingle_words > 1 else []
        if len(words) < shingle_words:
            last = words
            continue
        joined = b" ".join(words)
        ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
        starts = [0, *[e + 1 for e in ends]]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], HASH_SEED) for a, b in zip(starts, ends[shingle_words - 1:])]
        ones += _ones(np.array(hashes, np.uint64))
        total += len(hashes)
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(last), HASH_SEED) if last else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = 3) -> DataFrame:
    """(id, text_hash, fp): the fingerprint of every row as a signed 64-bit number. Null texts have no words."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py() or b"", shingle_words) for t in batch.column("data")]
            signed = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), signed], names=["id", "text_hash", "fp"])

    text = F.col(text_column)
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("data"))
    return rows.mapInArrow(of_batches, f"id {rows.schema['id'].dataType.simpleString()}, text_hash bigint, fp bigint")


def chain_budgets(max_bits: int, segments: int) -> list[int]:
    """The most bits in which a chain of 1, 2, ... segments may differ."""
    return [(length * max_bits) // segments for length in range(1, segments + 1)]


def key_masks(max_bits: int, segments: int) -> list[int]:
    """Which bits, counted from a chain's start, can be asked to be equal: one mask for each choice of the segment left out."""
    if 64 % segments or not 0 <= max_bits < segments:
        raise ValueError("segments must divide 64 and be more than max_bits")
    budgets, width = chain_budgets(max_bits, segments), 64 // segments
    equal = sum(b == 0 for b in budgets)
    one_off = sum(b == 1 for b in budgets)

    def mask(of: list[int]) -> int:
        return sum(((1 << width) - 1) << (64 - width * (s + 1)) for s in of)

    first = list(range(equal))
    later = list(range(equal, equal + one_off))
    return [mask(first + [s for s in later if s != left]) for left in later] or [mask(first)]


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def ring_keys(fps: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """(tag, key, fp) for every start on the ring and every mask."""
    width = 64 // segments
    masks = key_masks(max_bits, segments)
    starts = range(segments if max_bits else 1)
    options = []
    for start in starts:
        turn = start * width
        turned = F.shiftleft("fp", turn).bitwiseOR(F.shiftrightunsigned("fp", 64 - turn)) if turn else F.col("fp")
        for number, mask in enumerate(masks):
            key = turned.bitwiseAND(F.lit(_signed(mask)).cast("bigint"))
            options.append(F.struct(F.lit(start * len(masks) + number).cast("smallint").alias("tag"), key.alias("key")))
    return fps.select("fp", F.inline(F.array(*options)))


def within_chains(difference: np.ndarray, max_bits: int, segments: int) -> np.ndarray:
    """Which differences have a start from which every chain stays within its budget."""
    width = 64 // segments
    parts = [np.bitwise_count((difference >> np.uint64(64 - width * (s + 1))) & np.uint64((1 << width) - 1)) for s in range(segments)]
    budgets = chain_budgets(max_bits, segments)
    found = np.zeros(len(difference), bool)
    for start in range(segments):
        total, inside = np.zeros(len(difference), np.int64), np.ones(len(difference), bool)
        for length, budget in enumerate(budgets):
            total += parts[(start + length) % segments]
            inside &= total <= budget
        found |= inside
    return found


def _links(a: np.ndarray, b: np.ndarray, max_bits: int, segments: int) -> np.ndarray:
    """Which pairs differ in at most `max_bits` bits: the chains first, all bits for what they leave."""
    difference = a ^ b
    candidates = np.flatnonzero(within_chains(difference, max_bits, segments))
    return candidates[np.bitwise_count(difference[candidates]) <= max_bits]


def _forest(fps: np.ndarray, max_bits: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is linked among the fingerprints of one key: one for each but the first of a component."""
    low = np.arange(len(fps))
    heads, tails = [], []
    step = max(1, (1 << 18) // len(fps))
    for at in range(0, len(fps), step):
        rows = np.arange(at, min(at + step, len(fps)))
        i, j = np.repeat(rows, len(fps)), np.tile(np.arange(len(fps)), len(rows))
        upper = i < j
        i, j = i[upper], j[upper]
        kept = _links(fps[i], fps[j], max_bits, segments)
        heads.append(i[kept])
        tails.append(j[kept])
    i, j = np.concatenate(heads), np.concatenate(tails)
    while True:
        lower = np.minimum(low[i], low[j])
        after = low.copy()
        np.minimum.at(after, i, lower)
        np.minimum.at(after, j, lower)
        after = after[after]
        if np.array_equal(after, low):
            break
        low = after
    moved = np.flatnonzero(low != np.arange(len(fps)))
    return fps[low[moved]], fps[moved]


def _group_links(group: np.ndarray, fps: np.ndarray, max_bits: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups; `group` numbers the rows' groups and grows."""
    bounds = np.flatnonzero(np.diff(group, prepend=-1))
    sizes = np.diff(bounds, append=len(group))
    heads, tails = [], []
    few = np.repeat((sizes > 1) & (sizes <= FEW), sizes)
    number, values = group[few], fps[few]
    for lag in range(1, FEW):
        same = np.flatnonzero(number[lag:] == number[:-lag]) if len(number) > lag else np.empty(0, np.int64)
        if not len(same):
            break
        kept = same[_links(values[same], values[same + lag], max_bits, segments)]
        heads.append(values[kept])
        tails.append(values[kept + lag])
    for at in np.flatnonzero(sizes > FEW):
        a, b = _forest(fps[bounds[at]: bounds[at] + sizes[at]], max_bits, segments)
        heads.append(a)
        tails.append(b)
    empty = np.empty(0, np.uint64)
    return np.concatenate([empty, *heads]), np.concatenate([empty, *tails])


def links(fps: DataFrame, max_bits: int = 3, segments: int = 8, block: int = BLOCK) -> DataFrame:
    """(a, b): links among distinct fingerprints that have the same components as all links within `max_bits` bits.

    A key with more than `block` fingerprints is dealt out anew: its fingerprints get a block number from their own bits, every
    pair of blocks is a group of its own, and no task compares more than two blocks.
    """
    keyed = ring_keys(fps, max_bits, segments)
    crowded = cut_lineage(
        keyed.groupBy("tag", "key").agg(F.count("*").alias("n")).where(F.col("n") > block)
        .select("tag", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    if crowded.isEmpty():
        dealt = keyed.select("tag", "key", F.lit(0).alias("low"), F.lit(0).alias("high"), "fp")
    else:
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        dealt = (
            keyed.join(crowded, ["tag", "key"], "left")
            .select("tag", "key", "fp", own.alias("own"), F.coalesce("blocks", F.lit(1)).alias("blocks"))
            .select("tag", "key", "fp", F.coalesce("own", F.lit(0)).alias("own"), other.alias("other"))
            .select("tag", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")
        )
    columns = ["tag", "key", "low", "high"]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[np.ndarray] | None = None
        for batch in batches:
            arrays = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if left is not None:
                arrays = [np.concatenate(pair) for pair in zip(left, arrays)]
            if not len(arrays[0]):
                continue
            new = np.zeros(len(arrays[0]), bool)
            for values in arrays[:-1]:
                new[1:] |= values[1:] != values[:-1]
            start = np.flatnonzero(new)[-1] if new.any() else 0
            left = [values[start:].copy() for values in arrays]
            if start:
                yield of_groups(np.cumsum(new[:start]), arrays[-1][:start])
        if left is not None:
            yield of_groups(np.zeros(len(left[0]), np.int64), left[-1])

    def of_groups(group: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        a, b = _group_links(group, values.view(np.uint64), max_bits, segments)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    together = dealt.repartition(*columns).sortWithinPartitions(*columns)
    return together.mapInArrow(of_batches, "a bigint, b bigint")


def _first_of_components(marked: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """(of, first): for every fingerprint the first row, in the order (has an id, id, hash of the text), of its component."""
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    distinct = marked.groupBy("fp").agg(F.min(order).alias("first"))
    joined = cut_lineage(connected_components(links(distinct.select("fp"), max_bits, segments)))
    # Only fingerprints with a link have a row here.
    members = distinct.join(joined, F.col("fp") == F.col("node")).select("fp", "root", "first")
    lowest = members.groupBy("root").agg(F.min("first").alias("lowest"))
    linked = members.join(lowest, "root").select("fp", "lowest")
    return distinct.join(linked, "fp", "left").select(F.col("fp").alias("of"), F.coalesce("lowest", "first").alias("first"))


def simhash_components(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    shingle_words: int = 3, max_bits: int = 3, segments: int = 8,
) -> DataFrame:
    """(id, fingerprint, component_id) for every row of `docs`; other columns are not read.

    Fingerprints link at `max_bits` or fewer differing bits; component_id is the smallest id reachable over links, one's own
    included. Texts that are null or blank have fingerprint zero and link like any other. Rows with a null id take part in
    links; a component without any id has a null component_id. Repeated rows are rows of the result. No rows: no rows.
    """
    marked = cut_lineage(fingerprints(docs, id_column=id_column, text_column=text_column, shingle_words=shingle_words))
    labels = _first_of_components(marked, max_bits, segments)
    return marked.join(labels, F.col("fp") == F.col("of"), "left").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
    )


def one_of_each_component(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    shingle_words: int = 3, max_bits: int = 3, segments: int = 8,
) -> DataFrame:
    """`docs` without near copies: of every component one row stays, with all its columns as they were.

    That row is the one with the smallest id; rows without an id come last and among themselves in the order of a hash of their
    text. Of rows with the same id and text any one stays.
    """
    marked = cut_lineage(fingerprints(docs, id_column=id_column, text_column=text_column, shingle_words=shingle_words))
    firsts = _first_of_components(marked, max_bits, segments).select("first.id", "first.text_hash").distinct()
    firsts = firsts.select(F.struct("id", "text_hash").alias("kept"))
    mine = F.struct(docs[id_column].alias("id"), F.xxhash64(docs[text_column]).alias("text_hash"))
    here = docs.select(packed(docs), mine.alias("key"))
    found = here.join(firsts, F.col("key") == F.col("kept"), "left_semi")
    turn = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    return found.withColumn("turn", turn).where("turn = 1").select("row.*")
