"""Benchmark decontamination: an FM-index over each shard of the documents, searched backwards for the benchmark's phrases.

A shard is a bounded number of words of neighbouring documents, indexed and searched inside the task that reads them, so no
text is shuffled. Words that no benchmark item has cannot be part of an occurrence: they end a run, and runs shorter than the
shortest phrase are not indexed. The benchmark is sent to the tasks in blocks of bounded size, one pass over the shard's
documents for each.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recurra.llm.common import PIECE_BYTES, PLAIN, all_columns, map_batches, without
from recurra.llm.fm_index import FMIndex

WINDOW = 10
# Words of documents in one index; bytes of benchmark text that go to the tasks at once.
SHARD_WORDS = 2_000_000
BLOCK_BYTES = 16 << 20
SAMPLE = 8

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_ARROW = pa.struct([
    ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string())),
])


def plain_pieces(data: bytes) -> Iterator[list[bytes]]:
    """Plain words in lower case, a piece of a huge text at a time."""
    blanked = data.translate(PLAIN)
    at = 0
    while at < len(blanked):
        end = len(blanked) if at + PIECE_BYTES >= len(blanked) else blanked.find(b" ", at + PIECE_BYTES)
        end = end if end >= 0 else len(blanked)
        yield blanked[at:end].split()
        at = end


@dataclass
class Phrases:
    """Distinct phrases of a block of the benchmark: symbols by length, and the items that have each."""

    symbols: dict[bytes, int]
    by_length: dict[int, tuple[np.ndarray, list[list[str]]]]

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int) -> Phrases:
        symbols: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for name, data in items:
            words = [symbols.setdefault(w, len(symbols) + 1) for piece in plain_pieces(data) for w in piece]
            for at in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(tuple(words[at: at + window]), set()).add(name)
        lengths: dict[int, list[tuple[int, ...]]] = {}
        for phrase in owners:
            lengths.setdefault(len(phrase), []).append(phrase)
        return cls(symbols, {n: (np.array(p, np.int64), [sorted(owners[x]) for x in p]) for n, p in lengths.items()})

    @property
    def shortest(self) -> int:
        return min(self.by_length, default=1)


def _runs(words: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of symbols that are long enough to hold a phrase."""
    inside = np.concatenate([[False], words > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    kept = lengths >= shortest
    return starts[kept], lengths[kept]


def search_shard(shard: list[np.ndarray], phrases: Phrases, sample: int = SAMPLE) -> list[tuple[list[tuple[int, int]], list[str]]]:
    """Spans of hit words, merged and in order, and the items found, for each document given as its symbols (0: no item's word)."""
    sizes = np.array([len(d) + 1 for d in shard])
    begins = np.concatenate([[0], np.cumsum(sizes)])
    words = np.zeros(begins[-1], np.int32)
    for begin, document in zip(begins, shard):
        words[begin: begin + len(document)] = document
    starts, lengths = _runs(words, phrases.shortest)
    found: list[tuple[list[tuple[int, int]], list[str]]] = [([], []) for _ in shard]
    if not len(starts):
        return found
    # The runs one after the other, each with an end; `shift` leads from there back to the shard.
    places = np.concatenate([[0], np.cumsum(lengths + 1)])
    text = np.zeros(places[-1], np.int32)
    inner = np.repeat(starts - places[:-1], lengths + 1) + np.arange(places[-1])
    text[:] = words[np.minimum(inner, len(words) - 1)]
    text[places[1:] - 1] = 0
    shift = starts - places[:-1]
    index = FMIndex(text, sample)
    begin_at, end_at, owner = [], [], []
    items: dict[str, int] = {}
    for length, (patterns, owners) in phrases.by_length.items():
        low, high = index.search(patterns)
        hit = np.flatnonzero(high > low)
        counts = (high - low)[hit]
        if not len(hit):
            continue
        rows = np.repeat(low[hit] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        at = index.locate(rows)
        at = at + shift[np.searchsorted(places, at, side="right") - 1]
        begin_at.append(at)
        end_at.append(at + length)
        of = np.repeat(hit, counts)
        document = np.searchsorted(begins, at, side="right") - 1
        for pattern, number in np.unique(np.stack([of, document], axis=1), axis=0):
            for name in owners[pattern]:
                owner.append((int(number), items.setdefault(name, len(items))))
    if not begin_at:
        return found
    begin, end = np.concatenate(begin_at), np.concatenate(end_at)
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    # Occurrences that touch or overlap are one span; an end lies between documents, so none reaches into the next.
    first = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]))
    begin, end = begin[first], end[np.concatenate([first[1:], [len(end)]]) - 1]
    number = np.searchsorted(begins, begin, side="right") - 1
    for n, a, b in zip(number.tolist(), (begin - begins[number]).tolist(), (end - begins[number]).tolist()):
        found[n][0].append((a, b))
    names = list(items)
    for n, item in sorted(set(owner)):
        found[n][1].append(names[item])
    return found


def _merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(a + b):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _blocks(benchmark: DataFrame, item_column: str, text_column: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in blocks that the driver and a task can hold; one block is read at a time, an empty table is one block."""
    items = benchmark.select(
        F.coalesce(F.col(item_column).cast("string"), F.lit("")).alias("item"), F.col(text_column).cast("binary").alias("data")
    ).where("data is not null")
    total = items.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "data"), F.lit(blocks)))
    for number in range(blocks):
        yield [(r["item"], bytes(r["data"])) for r in dealt.where(F.col("block") == number).collect()]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, *, text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
    window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES, sample: int = SAMPLE,
    keep: list[str] | None = None, finish: tuple[Callable[[pa.RecordBatch], pa.RecordBatch], T.StructType] | None = None,
) -> DataFrame:
    """The columns `keep` of `docs` (all by default) and `found`: n_words, spans and items.

    Words are plain words in lower case. A phrase is `window` consecutive words of an item, or the whole of a shorter item that
    has a word. `spans` are the merged word ranges (begin, end; end is not in it) that lie in occurrences of phrases, `items` the
    distinct ids, as strings, of items with an occurrence, in order. A null text has no words; null items have no phrases; an
    item without an id is called "". An existing column `found` is replaced. Repeated rows are searched each by itself.

    `finish` (a function and the schema of its rows) makes rows of its own of each batch of the result, where that is found.
    """
    wanted = [c for c in (docs.columns if keep is None else keep) if c != "found"]
    chosen = [(c, name) for c, name in zip(all_columns(docs), docs.columns) if name in wanted]
    columns, names = [c for c, _ in chosen], [name for _, name in chosen]
    # A text that is kept is searched as it is kept, and moves once.
    kept_text = names.count(text_column) == 1 and isinstance(docs.schema[text_column].dataType, T.StringType)
    if not kept_text:
        columns.append(F.col(text_column).cast("binary").alias("found data"))
    at = names.index(text_column) if kept_text else len(names)
    result = docs.select(*columns, F.lit(None).cast(RESULT).alias("found"))
    blocks = _blocks(benchmark, item_column, item_text, block_bytes)
    block = next(blocks)
    for following in blocks:
        result = _searched(result, at, Phrases.of(block, window), shard_words, sample)
        block = following

    def last(batch: pa.RecordBatch) -> pa.RecordBatch:
        return finish[0](pa.RecordBatch.from_arrays([*batch.columns[: len(names)], batch.column(-1)], names=[*names, "found"]))

    result = _searched(result, at, Phrases.of(block, window), shard_words, sample, finish and (last, finish[1]))
    return result if finish else without(result, "found data")


def _bytes(column: pa.Array) -> pa.Array:
    """Texts as bytes, without a copy."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary())
    return column.cast(pa.binary()) if pa.types.is_string(column.type) else column


def _searched(
    docs: DataFrame, at: int, phrases: Phrases, shard_words: int, sample: int,
    finish: tuple[Callable[[pa.RecordBatch], pa.RecordBatch], T.StructType] | None = None,
) -> DataFrame:
    """One pass for one block over the texts in column `at`; what earlier passes found is merged with what this one finds."""
    sent = docs.sparkSession.sparkContext.broadcast(phrases)  # at most a block
    place = len(docs.columns) - 1
    names = docs.columns
    finished, schema = finish or (lambda batch: batch, docs.schema)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        lookup = known.symbols.get

        def symbols(data: bytes) -> np.ndarray:
            parts = [np.fromiter((lookup(w, 0) for w in words), np.int32, len(words)) for words in plain_pieces(data)]
            return np.concatenate(parts) if parts else np.empty(0, np.int32)

        def searched(rows: pa.RecordBatch, shard: list[np.ndarray]) -> pa.RecordBatch:
            results = []
            for before, document, (spans, items) in zip(rows.column(place).to_pylist(), shard, search_shard(shard, known, sample)):
                if before:
                    spans = _merged([(s["begin"], s["end"]) for s in before["spans"]], spans)
                    items = list({*before["items"], *items})
                results.append({
                    "n_words": len(document), "spans": [{"begin": a, "end": b} for a, b in spans], "items": sorted(items),
                })
            return finished(pa.RecordBatch.from_arrays([*rows.columns[:place], pa.array(results, _ARROW)], names=names))

        for batch in batches:
            first, shard, words = 0, [], 0
            texts = _bytes(batch.column(at))
            for number in range(batch.num_rows):
                shard.append(symbols(texts[number].as_py() or b""))
                words += len(shard[-1])
                if words >= shard_words:
                    yield searched(batch.slice(first, number + 1 - first), shard)
                    first, shard, words = number + 1, [], 0
            if shard:
                yield searched(batch.slice(first), shard)

    return map_batches(docs, of_batches, schema)


def without_spans(text: str | None, spans: list[dict[str, int]]) -> str | None:
    """The text without the words of the spans and what stands between them; one blank is left where both sides have words."""
    if text is None or not spans:
        return text
    data = text.encode()
    out, at, number = [], 0, 0
    ranges = iter(spans)
    span = next(ranges, None)
    for word in _WORD.finditer(data):
        if span is None:
            break
        if number == span["begin"]:
            out.append(data[at: word.start()])
        number += 1
        if number == span["end"]:
            at = word.end()
            span = next(ranges, None)
    out.append(data[at:])
    return b" ".join(p for p in out if p.strip()).decode()


def report(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) from what find_contamination returns."""
    spans, items = F.col("found.spans"), F.col("found.items")
    hit = F.aggregate(spans, F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["begin"])
    return found.select(
        id_column, F.col("found.n_words").alias("n_words"), hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_column: str = "text", **options) -> DataFrame:
    """`docs` without the passages found in the benchmark. A text that is nothing but such passages goes with its row; texts
    without a hit stay as they are, byte for byte."""
    kept = [f"c{n}" for n in range(len(docs.columns))]
    at = docs.columns.index(text_column)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(at)
        spans = [r["spans"] for r in batch.column(len(kept)).to_pylist()]
        hit = [n for n, s in enumerate(spans) if s]
        if hit:
            texts = column.to_pylist()
            for n in hit:
                texts[n] = without_spans(texts[n], spans[n])
            column = pa.array(texts, column.type)
            alive = pa.array([not s or _WORD.search(texts[n].encode()) is not None for n, s in enumerate(spans)])
        columns = [column if n == at else c for n, c in enumerate(batch.columns[: len(kept)])]
        out = pa.RecordBatch.from_arrays(columns, names=kept)
        return out.filter(alive) if hit else out

    # In the pass that finds the spans: a second one would be another Python process beside the first, with every text again.
    return find_contamination(docs.toDF(*kept), benchmark, text_column=kept[at], finish=(cut, docs.schema), **options)
