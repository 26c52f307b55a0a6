"""Scores of whole documents by a recurrent language model that is learned from the corpus.

1. Words of all training documents are counted (pre-counted inside the tasks). A bounded number of the most frequent ones are sent to
   all tasks, the first of them are the model's words; the other counts stay a table and are joined by word.
2. Every text is cut into words and looked up once; its model words, as numbers, its sums and its rare words go to the shared folder.
3. The model (see gru.py) is trained on all training documents in rounds. In a round every task trains a copy on its documents of one
   slice; the copies are averaged by the number of words they saw. What reaches the driver is one model.
4. Every document is scored whole, with the state carried from window to window. Words the model does not have are scored as one
   unknown word, times their share of all such words, so that the scores of all texts still sum to one.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from recurra.llm import gru
from recurra.llm.common import word_pieces
from recurra.session import cut_lineage

PARTS, HELD_OUT = 7, 2
# Words whose counts every task gets.
FREQUENT = 1 << 18
# Words of the model itself (with the end and the unknown word): the first number up to so many training tokens, twice as many for every 16 times the
# tokens, and at most as many as are sent; classes are the root of the words, by a quarter less.
MODEL_WORDS, MODEL_TOKENS = 1024, 1 << 27
ROUNDS = 2
RATE = 0.15
# Different words that a task counts before it passes its counts on.
COUNTED_AT_ONCE = 500_000


def is_held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning, by its id as text; rows without an id are learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % PARTS == HELD_OUT, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of the texts (data): blank-separated words, A-Z in lower case, as bytes."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for data in batch.column(0):
                for words in word_pieces((data.as_py() or b"").lower()):
                    counts.update(words)
                    if len(counts) >= COUNTED_AT_ONCE:
                        yield counted()
                        counts.clear()
        if counts:
            yield counted()

    return texts.mapInArrow(of_batches, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def model_size(tokens: int) -> int:
    """Words of the model for a corpus of so many training tokens."""
    doublings = max(0, math.floor(math.log2(max(tokens, 1) / MODEL_TOKENS) / 4 + 1))
    return min(MODEL_WORDS << doublings, FREQUENT)


def class_count(words: int) -> int:
    return max(2, math.isqrt(words) * 3 // 4)


@dataclass
class Lexicon:
    """Frequent words in order of their counts, and the model's words: the first `own` of those, the end of a text and the unknown."""

    place: dict[bytes, int]
    log_counts: np.ndarray
    model_of: np.ndarray
    end: int
    unknown: int
    model_counts: np.ndarray
    tokens: int
    types: int
    unknown_total: int

    @classmethod
    def of(cls, counts: DataFrame, texts: int, frequent: int, model_words: int | None) -> Lexicon:
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("types")).first()
        # The lowest count that at most `frequent` words reach: one row for each different count, so few that a task has them all.
        levels = counts.groupBy("n").agg(F.count("*").alias("words"))
        reached = levels.select("n", F.sum("words").over(Window.orderBy(F.desc("n"))).alias("reached"))
        cut = reached.where(F.col("reached") <= frequent).agg(F.min("n").alias("n")).first()["n"]
        # At most `frequent` rows reach the driver.
        rows = sorted(counts.where(F.col("n") >= F.lit(cut)).collect(), key=lambda r: (-r["n"], bytes(r["word"])))
        found = np.array([r["n"] for r in rows], np.int64)
        own = min(len(rows), (model_words or model_size(total["n"])) - 2)
        unknown = total["n"] - int(found[:own].sum())
        model = np.concatenate([found[:own], [texts, unknown]]).astype(np.float64)
        order = np.argsort(-model, kind="stable")
        number = np.empty(len(model), np.int64)
        number[order] = np.arange(len(model))
        model_of = np.full(len(rows) + 1, number[own + 1], np.int32)
        model_of[:own] = number[:own]
        return cls(
            {bytes(r["word"]): i for i, r in enumerate(rows)}, np.log10(found + 1.0), model_of, int(number[own]), int(number[own + 1]),
            model[order], total["n"] + texts, total["types"] + (texts > 0), unknown + total["types"] - own + 1,
        )

    def places(self, words: list[bytes]) -> np.ndarray:
        """Places among the frequent words, -1 for others."""
        return np.fromiter(map(self.place.get, words, repeat(-1)), np.int32, len(words))

    @property
    def kind(self) -> type:
        """Of the numbers of the model's words."""
        return np.int16 if len(self.model_counts) <= np.iinfo(np.int16).max else np.int32


def _longest_first(texts: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    for number in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        yield number, texts[number]


def _read(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """`rows` (row, id, held_out, slice, data) with the model's words in place of the data, sums over what the tasks know, and the rare words."""
    sent = rows.sparkSession.sparkContext.broadcast(lexicon)  # a bounded number of words
    schema = (
        f"row bigint, id {rows.schema['id'].dataType.simpleString()}, held_out boolean, slice int, n_tokens bigint, n_frequent bigint, n_unknown bigint, "
        "all_logs double, unknown_logs double, symbols binary, rare array<struct<word:binary,n:int>>"
    )
    names = [part.strip().split()[0] for part in schema.split(", ")]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = sent.value
        own = words_of.model_of[:-1] != words_of.unknown
        end = np.array([words_of.end], words_of.kind)
        for batch in batches:
            symbols, sums = [], np.zeros((batch.num_rows, 5))
            offsets, words, numbers = [0], [], []
            for row, data in enumerate(batch.column(4)):
                rare: Counter = Counter()
                parts = []
                for piece in word_pieces((data.as_py() or b"").lower()):
                    places = words_of.places(piece)
                    parts.append(words_of.model_of[places].astype(words_of.kind))
                    known = places[places >= 0]
                    logs = words_of.log_counts[known]
                    unknown = ~own[known]
                    sums[row] += (len(piece), len(known), len(piece) - len(known) + unknown.sum(), logs.sum(), logs[unknown].sum())
                    rare.update([piece[i] for i in np.flatnonzero(places < 0)])
                symbols.append(np.concatenate([*parts, end]).tobytes())
                words += rare.keys()
                numbers += rare.values()
                offsets.append(len(words))
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(numbers, pa.int32())], names=["word", "n"])
            )
            whole = [pa.array(sums[:, i].astype(np.int64)) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], *whole, pa.array(sums[:, 3]), pa.array(sums[:, 4]), pa.array(symbols, pa.binary()), lists], names=names
            )

    return rows.mapInArrow(of_batches, schema)


def _numbers(column: pa.Array, kind: type) -> list[np.ndarray]:
    """Texts as numbers of the model's words, as _read has stored them."""
    return [np.frombuffer(data.as_buffer(), kind).astype(np.int32) for data in column]


def train(
    texts: DataFrame, lexicon: Lexicon, *, classes: int | None, hidden: int, rounds: int, rate: float
) -> tuple[gru.Parameters, np.ndarray]:
    """The model after one pass over all texts (symbols, slice) in `rounds` slices."""
    bounds = gru.class_bounds(lexicon.model_counts, classes or class_count(len(lexicon.model_counts)))
    parameters = gru.initial(lexicon.model_counts, bounds, hidden)
    context, kind = texts.sparkSession.sparkContext, lexicon.kind
    for number in range(rounds):
        flat = parameters.flat()
        sent = context.broadcast(flat)  # as large as the model

        def of_batches(batches: Iterator[pa.RecordBatch], sent=sent, like=parameters) -> Iterator[pa.RecordBatch]:
            model = gru.Model(gru.Parameters.shaped(sent.value.copy(), like), bounds)
            seen, squares = 0, None
            for batch in batches:
                n, squares = model.train(_longest_first(_numbers(batch.column(0), kind)), rate, squares)
                seen += n
            if seen:
                learned = model.p.flat().astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(learned))), pa.array(learned * seen), pa.array(np.full(len(learned), seen))],
                    names=["place", "value", "weight"],
                )

        copies = texts.where(F.col("slice") == number).select("symbols").mapInArrow(of_batches, "place bigint, value double, weight bigint")
        mean = copies.groupBy("place").agg((F.sum("value") / F.sum("weight")).alias("mean")).toPandas()
        flat = flat.astype(np.float64)
        flat[mean["place"].to_numpy(np.int64)] = mean["mean"].to_numpy(np.float64)
        parameters = gru.Parameters.shaped(flat, parameters)
    return parameters, bounds


def _scored(rows: DataFrame, lexicon: Lexicon, parameters: gru.Parameters, bounds: np.ndarray) -> DataFrame:
    """`rows` as read, with model_score, the logarithm of the model's probability of a text's model words, in place of those."""
    sent = rows.sparkSession.sparkContext.broadcast((parameters, bounds))  # as large as the model
    kind, place = lexicon.kind, rows.columns.index("symbols")
    schema = StructType([StructField("model_score", DoubleType()) if f.name == "symbols" else f for f in rows.schema.fields])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = gru.Model(*sent.value)
        for batch in batches:
            totals = np.zeros(batch.num_rows)
            model.score(_longest_first(_numbers(batch.column(place), kind)), totals)
            yield batch.set_column(place, "model_score", pa.array(totals / math.log(10)))

    return rows.mapInArrow(of_batches, schema)


def score_documents(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", frequent: int = FREQUENT, model_words: int | None = None,
    classes: int | None = None, hidden: int = gru.HIDDEN, rounds: int = ROUNDS, rate: float = RATE,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row; scores are log10 of probabilities.

    Tokens are the words and one end for each text; a null text has only its end. base_score is the sum of
    log10((c + 1) / (N + V + 1)) with the counts of the training tokens. Texts of any length are read in pieces and scored whole, window by
    window. The model's words are as many as the corpus asks for, unless `model_words` says. Repeated rows are learned from and scored each time; rows
    without an id are learned from. Words of equal counts are taken by their bytes. Without training documents every count is 0. Other columns are
    not read. No rows: no rows.
    """
    doc_id, text = F.col(id_column), F.col(text_column)
    counts = cut_lineage(word_counts(docs.where(~is_held_out(doc_id)).select(text.cast("binary").alias("data"))))
    lexicon = Lexicon.of(counts, docs.where(~is_held_out(doc_id)).count(), frequent, model_words)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), doc_id.alias("id"), is_held_out(doc_id).alias("held_out"),
        F.pmod(F.xxhash64(doc_id.cast("string"), text), F.lit(rounds)).cast("int").alias("slice"), text.cast("binary").alias("data"),
    )
    # Written once: the training rounds and the scores read it, and a task that runs again finds the numbers that rows were given.
    read = cut_lineage(_read(rows, lexicon))
    parameters, bounds = train(read.where(~F.col("held_out")), lexicon, classes=classes, hidden=hidden, rounds=rounds, rate=rate)
    scored = _scored(read.drop("slice"), lexicon, parameters, bounds)
    # What is known of a text travels once, under a key of its own (with a blank, so it is no word) that adds nothing; beside its
    # rare words those columns are null.
    own = F.concat(F.lit(" "), F.col("row").cast("string")).cast("binary")
    about = [c for c in scored.columns if c not in ("row", "rare")]
    whole = F.array(F.struct(own.alias("word"), F.lit(0).alias("n")))
    spread = scored.select("row", *about, F.inline(F.concat(whole, "rare"))).select(
        "row", *[F.when(F.col("n") == 0, F.col(c)).alias(c) for c in about], "word", "n"
    )
    known = counts.select(F.col("word").alias("known_word"), F.col("n").alias("c"))
    logs = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)
    rare = spread.join(known, F.col("word") == F.col("known_word"), "left").groupBy("row").agg(
        *[F.any_value(c, True).alias(c) for c in about],
        F.sum(logs).alias("rare_logs"), F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("n_rare_known"),
    )
    tokens = F.col("n_tokens") + 1
    ends = int(lexicon.model_counts[lexicon.end])
    base = F.col("all_logs") + F.col("rare_logs") + math.log10(ends + 1) - tokens * math.log10(lexicon.tokens + lexicon.types + 1)
    score = F.col("model_score") + F.col("unknown_logs") + F.col("rare_logs") - F.col("n_unknown") * math.log10(lexicon.unknown_total)
    return rare.select(
        F.col("id").alias(id_column), "held_out", tokens.alias("n_tokens"),
        (F.col("n_frequent") + F.col("n_rare_known") + int(ends > 0)).cast("bigint").alias("n_known"),
        F.lit(lexicon.tokens).cast("bigint").alias("train_tokens"), base.alias("base_score"), score.alias("score"),
    )
