"""Toxicity by compression distance: a window of text is compressed with a zstandard dictionary of ordinary text and with one that
has toxic text as well, and what the second saves tells how toxic the window is.

1. A bounded sample of labelled documents, by the smallest hashes of their ids, is taken from the rows that may be learned from. Two
   thirds of it make the dictionaries, the rest sets the threshold.
2. The ordinary dictionary is trained on windows of the ordinary documents. The toxic one is trained on the words that toxic documents
   have far more often than chance explains, each as often as toxic documents have it, followed by the ordinary dictionary. So text that is
   neither is compressed as well by both, and what is saved is not a matter of language or subject. Ordinary windows that the toxic
   dictionary helps all the same are then added to both, in rounds.
3. Every document is cut into windows of words, to its end. Bytes saved by window become three sums: savings over the root of the windows, the best window and the
   mean of the two best. A logistic function of them is fitted on the held-back third, and moved so that 0.7 is the threshold that
   divides those documents best; a clean document that is rejected weighs as much as four toxic ones that are not found.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import computed_once, map_batches, packed, spaced_words, word_pieces
from recurra.session import cut_lineage

PARTS, HELD_OUT = 3, 1
# Labelled documents of either kind that are learned from at most, the ones with the smallest hashes of their ids.
SAMPLE = 8_000
# Words of the toxic dictionary, windows that train the ordinary one, and the bytes of both. These bound what the driver gets.
WORDS, WINDOWS = 4_096, 60_000
TOXIC_BYTES, ORDINARY_BYTES = 2_048, 81_920
# Rounds in which the ordinary windows that the toxic dictionary helps most are added to the ordinary one, and their bytes.
HARD_ROUNDS, HARD_BYTES = 3, 16_384
# A toxic word is one that toxic documents have this many standard deviations, and this many times, more often than ordinary ones.
SIGNIFICANT, TIMES = 3.0, 4.0
WINDOW_WORDS, WINDOW_BYTES = 24, 512
LEVEL, STRATEGY, MIN_MATCH = 3, zstandard.STRATEGY_BTOPT, 3
THRESHOLD, CLEAN_WEIGHT = 0.7, 4.0
# What bounds the steepness of the logistic function where it divides the kinds without a fault.
RIDGE = 0.05


def is_held_out(doc_id: Column) -> Column:
    """Whether the labels of a document are kept from learning, by its id as text; rows without an id have no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % PARTS == HELD_OUT, F.lit(False))


def labelled_sample(labels: DataFrame, sample: int) -> DataFrame:
    """(labelled_id, toxic, calibrates): at most `sample` ids of each kind that may be learned from. Ids with both labels are of no kind."""
    kinds = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.min("toxic").alias("low"), F.max("toxic").alias("high")
    ).where(F.col("low") == F.col("high"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [kinds.where(F.col("high") == kind).orderBy(*order).limit(sample) for kind in (0, 1)]
    third = F.pmod(F.xxhash64("doc_id", F.lit("calibrates")), F.lit(3)) == 0
    return reduce(DataFrame.union, chosen).select(F.col("doc_id").alias("labelled_id"), (F.col("high") == 1).alias("toxic"), third.alias("calibrates"))


def windows(data: bytes) -> Iterator[bytes]:
    """A text in runs of words, in lower case (A-Z), to its end; a run that is long in bytes is several windows."""
    for words in word_pieces(data.lower()):
        for at in range(0, len(words), WINDOW_WORDS):
            run = b" ".join(words[at: at + WINDOW_WORDS])
            for start in range(0, len(run), WINDOW_BYTES):
                yield run[start: start + WINDOW_BYTES]


def toxic_words(sampled: DataFrame, *, words: int, significant: float = SIGNIFICANT, times: float = TIMES) -> list[tuple[str, int]]:
    """(word, documents) of at most `words` words of the toxic documents, by significance. Documents are counted, not places."""
    sizes = {r["toxic"]: r["n"] for r in sampled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return []
    text = F.lower(F.col("text").cast("string"))
    split = computed_once(sampled.select("toxic", text.alias("text")), "word", F.array_distinct(spaced_words(F.col("text"))))
    counted = split.select("toxic", F.explode("word").alias("word")).groupBy("word").agg(F.count_if("toxic").alias("t"), F.count_if(~F.col("toxic")).alias("c"))
    in_toxic, in_ordinary = F.col("t") / sizes[True], F.col("c") / sizes[False]
    share = (F.col("t") + F.col("c") + 1) / (sizes[True] + sizes[False] + 2)
    deviation = F.sqrt(share * (1 - share) * (1 / sizes[True] + 1 / sizes[False]))
    much_more = (F.col("t") + 0.5) / (sizes[True] + 1) > times * (F.col("c") + 0.5) / (sizes[False] + 1)
    found = counted.where((F.col("t") > 1) & (share < 1) & much_more).withColumn("z", (in_toxic - in_ordinary) / deviation)
    best = found.where(F.col("z") > significant).orderBy(F.desc("z"), "word").limit(words)
    # A word longer than a window never fits in one.
    return [(r["word"], r["t"]) for r in best.collect() if len(r["word"].encode()) < WINDOW_BYTES]


def ordinary_windows(sampled: DataFrame, *, most: int) -> list[bytes]:
    """At most `most` windows of the ordinary documents, the ones with the smallest hashes."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(list(windows(data.as_py() or b"")), pa.binary())], names=["piece"])

    cut = sampled.where(~F.col("toxic")).select(F.col("text").cast("binary").alias("text")).mapInArrow(of_batches, "piece binary")
    chosen = cut.groupBy("piece").agg(F.count("*").alias("n")).orderBy(F.xxhash64("piece"), "piece").limit(most)
    return [bytes(r["piece"]) for r in chosen.select("piece").collect()]


def _trained(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary; of samples too few or too small to train one, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, d=6, k=32).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


@dataclass
class Dictionaries:
    toxic: bytes
    ordinary: bytes

    @classmethod
    def of(cls, words: list[tuple[str, int]], pieces: list[bytes], toxic_bytes: int, ordinary_bytes: int, rounds: int, hard_bytes: int) -> Dictionaries:
        shuffled = random.Random(11)
        ordinary = list(pieces)
        shuffled.shuffle(ordinary)
        repeated = [word.encode() for word, times in words for _ in range(min(times, 200))]
        shuffled.shuffle(repeated)
        samples = [b" ".join(repeated[i: i + 8]) for i in range(0, len(repeated), 8)]
        found = cls(_trained(samples, toxic_bytes), _trained(ordinary, ordinary_bytes))
        for _ in range(rounds):
            plain, toxic = found.compressors()
            hardest = sorted((len(toxic.compress(p)) - len(plain.compress(p)), p) for p in pieces)
            found = cls(found.toxic, b" ".join([p for _, p in hardest])[:hard_bytes] + found.ordinary)
        return found

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        """With the ordinary dictionary, and with the toxic one before it."""
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, strategy=STRATEGY, min_match=MIN_MATCH, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0, write_checksum=0
        )
        found = []
        for content in (self.ordinary, self.toxic + self.ordinary):
            if not content:
                found.append(zstandard.ZstdCompressor(compression_params=settings))
                continue
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=settings)
            found.append(zstandard.ZstdCompressor(dict_data=known, compression_params=settings))
        return found


def savings(data: bytes, ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> tuple[float, float, float]:
    """Bytes that the toxic dictionary saves over the root of the windows, in the best window, and in the two best on average."""
    n, total, best, second = 0, 0, 0, 0
    for window in windows(data):
        saved = len(ordinary.compress(window)) - len(toxic.compress(window))
        n += 1
        total += max(saved, 0)
        if saved > best:
            best, second = saved, best
        elif saved > second:
            second = saved
    return total / math.sqrt(max(n, 1)), float(best), (best + second) / 2


def fit_logistic(features: np.ndarray, toxic: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights of the features and, last, the constant; both kinds count alike in sum. Newton's method, from zero."""
    x = np.column_stack([features, np.ones(len(features))])
    y = toxic.astype(float)
    share = np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1)) * len(y)
    w = np.zeros(x.shape[1])
    damp = np.diag([ridge] * features.shape[1] + [1e-6]) * len(y) / 100
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + damp @ w
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + damp + 1e-9 * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def best_threshold(values: np.ndarray, toxic: np.ndarray, clean_weight: float = CLEAN_WEIGHT) -> float:
    """Where the share of toxic values below and `clean_weight` times that of clean ones above add up to least, halfway between two
    values; of several as good the middle one."""
    levels = np.unique(values)
    cuts = np.concatenate([[levels[0] - 1], (levels[1:] + levels[:-1]) / 2, [levels[-1] + 1]])
    below = np.searchsorted(np.sort(values[toxic]), cuts) / max(toxic.sum(), 1)
    above = 1 - np.searchsorted(np.sort(values[~toxic]), cuts) / max((~toxic).sum(), 1)
    cost = below + clean_weight * above
    least = np.flatnonzero(cost <= cost.min() + 1e-12)
    return float(cuts[least[len(least) // 2]])


@dataclass
class Classifier:
    """Dictionaries, and the weights of a document's three savings with a constant; no dictionaries: nothing was learned."""

    dictionaries: Dictionaries | None
    weights: np.ndarray

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _with_features(rows: DataFrame, dictionaries: Dictionaries) -> DataFrame:
    """`rows` with a column `features` made of the last one, a binary text, which goes."""
    sent = rows.sparkSession.sparkContext.broadcast(dictionaries)  # two dictionaries of fixed size

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinary, toxic = sent.value.compressors()
        for batch in batches:
            found = [list(savings(data.as_py() or b"", ordinary, toxic)) for data in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.float64()))], names=[*batch.schema.names[:-1], "features"])

    schema = rows.select(*rows.columns[:-1], F.array(F.lit(0.0)).alias("features")).schema
    return map_batches(rows, of_batches, schema)


def learn(
    docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE, words: int = WORDS,
    most_windows: int = WINDOWS, toxic_bytes: int = TOXIC_BYTES, ordinary_bytes: int = ORDINARY_BYTES, hard_rounds: int = HARD_ROUNDS,
    hard_bytes: int = HARD_BYTES,
) -> Classifier:
    """Dictionaries and threshold from labelled rows that are not held out. Without labels of both kinds among them nothing is learned."""
    labelled = labelled_sample(labels, sample)
    known = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(F.broadcast(labelled), F.col("id") == F.col("labelled_id"))
    known = cut_lineage(known.select("text", "toxic", "calibrates"))
    fits = known.where(~F.col("calibrates"))
    found = toxic_words(fits, words=words)
    if not found:
        return Classifier(None, np.zeros(4))
    dictionaries = Dictionaries.of(found, ordinary_windows(fits, most=most_windows), toxic_bytes, ordinary_bytes, hard_rounds, hard_bytes)
    rows = _with_features(known.where("calibrates").select("toxic", F.col("text").cast("binary").alias("text")), dictionaries).collect()
    if len({r["toxic"] for r in rows}) < 2:
        rows = _with_features(known.select("toxic", F.col("text").cast("binary").alias("text")), dictionaries).collect()
    # The sums of floating-point numbers below depend on the order of rows.
    rows.sort(key=lambda r: (r["toxic"], r["features"]))
    features, toxic = np.array([r["features"] for r in rows]), np.array([r["toxic"] for r in rows])
    weights = fit_logistic(features, toxic)
    weights[-1] += math.log(THRESHOLD / (1 - THRESHOLD)) - best_threshold(features @ weights[:-1] + weights[-1], toxic)
    return Classifier(dictionaries, weights)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, *, keep: Sequence[str] | None = None, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """`row` (the columns of `docs`, or those to `keep`) with held_out, score (0 to 1) and predicted (1 from a score of 0.7 on).

    The score depends on the text alone. Null and empty texts have no windows and save nothing;
    texts of any length are scored whole, window by window. Rows that repeat are scored each time, rows without an id are scored and never learned from. A
    score equal to the threshold is predicted 1. Ids labelled both ways, null labels and labels of unknown ids are left out. Where nothing
    can be learned (labels of one kind only, or no word tells them apart) every score is 0.5. No rows: no rows.
    """
    model = learn(docs, labels, id_column=id_column, text_column=text_column, **options)
    held_out = is_held_out(F.col(id_column))
    row = packed(docs if keep is None else docs.select(*keep))
    if model.dictionaries is None:
        return docs.select(row, held_out.alias("held_out"), F.lit(0.5).alias("score"), F.lit(0).alias("predicted"))
    found = _with_features(docs.select(row, held_out.alias("held_out"), F.col(text_column).cast("binary").alias("data")), model.dictionaries)
    linear = reduce(Column.__add__, [F.col("features")[i] * float(w) for i, w in enumerate(model.weights[:-1])], F.lit(float(model.weights[-1])))
    score = 1 / (1 + F.exp(-F.greatest(F.least(linear, F.lit(30.0)), F.lit(-30.0))))
    return found.select("row", "held_out", score.alias("score")).withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
