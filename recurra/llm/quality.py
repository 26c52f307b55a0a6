"""Quality rules: counts of each document, how much its n-grams look like trusted text rather than like the whole corpus, and how
much its words look like toxic text rather than like clean text.

Words and pairs of neighbouring words are hashed to a fixed number of buckets. Bucket counts of all documents are the raw
multinomial, those of one half of a bounded sample of documents labelled as good the trusted one. A document's score is the mean
over its n-grams of log(trusted / raw). Toxic text is mostly well written, so that this does not tell it: the words that one half of
the documents labelled toxic have significantly more often than documents labelled clean are markers, and a document's toxicity is
the sum of log(toxic / clean) of its markers over the root of its words. Both limits are set where they divide the scores of single
documents best that the fit has not seen: of the other half of the good and of the bad ones, and of the other halves of toxic and
clean ones. Where that is no better than chance allows, the first lies between the mean scores of bad and of good n-grams. Everything is built of DataFrame functions; the only things that leave the executors are one row a bucket, the markers
and the scores of the labelled sample.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import BLANKS, computed_once, packed, spaced_words
from recurra.session import cut_lineage

BUCKETS = 1 << 14
SMOOTHING = 1.0
# Labelled documents of each kind, the ones with the smallest hashes of their ids. This bounds what is broadcast.
SAMPLE = 20_000
# Where the limit lies between the means of bad (0) and good (1) labelled text, unless single documents show a better one.
PLACE = 0.75
# At most so many words mark toxic text: those that are most significant, from so many standard deviations on.
MARKERS = 1024
SIGNIFICANT = 3.0
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
# Words that the windows of repeated words have.
REPEAT_WINDOW = 3


def _bucket(hashed: Column, buckets: int) -> Column:
    low_bits = hashed.bitwiseAND(buckets - 1) if buckets & (buckets - 1) == 0 else F.pmod(hashed, F.lit(buckets))
    return low_bits.cast("int")


def _neighbours(elements: Column) -> Column:
    """A hash of every element with the next one; one element fewer, as the last has none."""
    fewer = F.greatest(F.size(elements) - 1, F.lit(0))
    hashes = F.zip_with(elements, F.slice(elements, 2, fewer), lambda a, b: F.xxhash64(a, b))
    return F.slice(hashes, 1, fewer)


def _hashed(df: DataFrame) -> DataFrame:
    """`df` with `hashes` of its `words` and `pairs`, hashes of two neighbours, in their place: all that follows works on numbers."""
    df = computed_once(df, "hashes", F.transform("words", lambda word: F.xxhash64(word)))
    return computed_once(df, "pairs", _neighbours(F.col("words"))).drop("words")


def labelled_sample(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(labelled_id, fitted, good, bad, toxic, clean): at most `sample` documents labelled good and not toxic, as many labelled bad,
    as many labelled toxic and as many labelled not toxic, each id once; `fitted` are the half of them that is not held out. Ids
    with both kinds of label are of neither kind; null ids and labels are left out."""
    toxic = F.coalesce("toxic", F.lit(0))
    kinds = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.min(F.when(F.col("quality").isNotNull(), F.when((F.col("quality") == 1) & (toxic == 0), 1).otherwise(0))).alias("low"),
        F.max("quality").alias("high"), F.min("toxic").alias("least_toxic"), F.max("toxic").alias("most_toxic"),
    )
    which = {
        "good": (F.col("low") == 1) & (F.coalesce("most_toxic", F.lit(0)) == 0), "bad": F.col("high") == 0,
        "toxic": F.col("least_toxic") == 1, "clean": F.col("most_toxic") == 0,
    }
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [kinds.where(is_kind).orderBy(*order).limit(sample).select("doc_id", F.lit(kind).alias("kind")) for kind, is_kind in which.items()]
    flags = [F.max(F.col("kind") == kind).alias(kind) for kind in which]
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    return reduce(DataFrame.union, chosen).groupBy(F.col("doc_id").alias("labelled_id"), half.alias("fitted")).agg(*flags)


def _known(docs: DataFrame, labelled: DataFrame, how: str) -> DataFrame:
    """(id, text) of documents, with what the labelled sample says of them."""
    return docs.join(F.broadcast(labelled), F.col("id") == F.col("labelled_id"), how)


def bucket_counts(docs: DataFrame, labelled: DataFrame, *, buckets: int) -> DataFrame:
    """(bucket, raw, good, held): n-grams of all documents, and of the two halves of the good ones. A row a bucket at most leaves a task."""
    known = computed_once(_known(docs, labelled.where("good").select("labelled_id", "fitted"), "left"), "words", spaced_words(F.col("text")))
    # Every word with the next one, so that what follows is a plain projection of rows and not done inside arrays.
    pairs = known.select("fitted", F.inline(F.arrays_zip(F.col("words").alias("word"), F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))).alias("after"))))
    single, pair = _bucket(F.xxhash64("word"), buckets), _bucket(F.xxhash64("word", "after"), buckets)
    both = F.when(F.col("after").isNull(), F.array(single)).otherwise(F.array(single, pair))
    grams = pairs.select("fitted", F.explode(both).alias("bucket"))
    return grams.groupBy("bucket").agg(
        F.count("*").alias("raw"), F.count_if("fitted").alias("good"), F.count_if(~F.col("fitted")).alias("held")
    )


def fit(counts: DataFrame, *, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> list[float]:
    """Log-likelihood ratio of every bucket; without good documents all are 0."""
    found = {kind: [0] * buckets for kind in ("raw", "good", "held")}
    for row in counts.collect():  # a row a bucket
        for kind, numbers in found.items():
            numbers[row["bucket"]] = row[kind]
    raw, good, held = found.values()
    if not sum(good):
        good = held
    if not sum(good):
        return [0.0] * buckets
    of_good, of_raw = sum(good) + smoothing * buckets, sum(raw) + smoothing * buckets
    return [math.log((g + smoothing) / of_good) - math.log((r + smoothing) / of_raw) for g, r in zip(good, raw)]


def toxic_markers(docs: DataFrame, labelled: DataFrame, *, markers: int = MARKERS, significant: float = SIGNIFICANT) -> dict[int, float]:
    """log(toxic / clean), by the documents that have the word, of hashes of words that toxic documents have more often than chance explains.

    Documents are counted, not places, so that a text that repeats a word does not make it a marker. None without both kinds."""
    texts = _known(docs, labelled.where("toxic or clean"), "inner")
    sizes = texts.groupBy("fitted").agg(F.count_if("toxic").alias("toxic"), F.count_if("clean").alias("clean")).collect()
    # The fitted half, or the other one if that has no toxic or no clean document.
    usable = {r["fitted"]: (r["toxic"], r["clean"]) for r in sizes if r["toxic"] and r["clean"]}
    if not usable:
        return {}
    half = max(usable)
    of_toxic, of_clean = usable[half]
    words = texts.where(F.col("fitted") == half).select(F.explode(F.array_distinct(spaced_words(F.col("text")))).alias("word"), "toxic", "clean")
    counted = words.groupBy("word").agg(F.count_if("toxic").alias("t"), F.count_if("clean").alias("c")).where("t > 1")
    share = (F.col("t") + F.col("c") + 1) / (of_toxic + of_clean + 2)
    deviation = F.sqrt(share * (1 - share) * (1 / of_toxic + 1 / of_clean))
    # A word that everything has tells nothing, and its share may reach 1.
    counted = counted.where(share < 1).withColumn("z", (F.col("t") / of_toxic - F.col("c") / of_clean) / deviation)
    ratio = F.log((F.col("t") + 0.5) / (of_toxic + 1)) - F.log((F.col("c") + 0.5) / (of_clean + 1))
    best = counted.where(F.col("z") > significant).orderBy(F.desc("z"), "word").limit(markers)
    return {r["hash"]: r["ratio"] for r in best.select(F.xxhash64("word").alias("hash"), ratio.alias("ratio")).collect()}


def _score(ratios: list[float]) -> Column:
    """Mean log ratio of the n-grams in `hashes` and `pairs`; 0 without words."""
    # One constant of as many numbers as buckets.
    table, buckets = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>"), len(ratios)
    grams = F.concat("hashes", "pairs")
    total = F.aggregate(grams, F.lit(0.0), lambda sum_, gram: sum_ + F.get(table, _bucket(gram, buckets)))
    return total / F.greatest(F.size("hashes") + F.size("pairs"), F.lit(1))


def _toxicity(markers: dict[int, float]) -> Column:
    """Sum of the log ratios of the markers in `hashes`, over the root of its words."""
    if not markers:
        return F.lit(0.0)
    names, values = (F.split(F.lit(",".join(map(repr, of))), ",") for of in (markers, markers.values()))
    table = F.map_from_arrays(names.cast("array<bigint>"), values.cast("array<double>"))
    hits = F.filter("hashes", lambda word: word.isin(*markers))
    total = F.aggregate(hits, F.lit(0.0), lambda sum_, word: sum_ + F.try_element_at(table, word))
    return total / F.sqrt(F.greatest(F.size("hashes"), F.lit(1)).cast("double"))


def best_limit(low: list[float], high: list[float], start: float = -math.inf) -> float:
    """The limit at which the share of `high` that reaches it is most above that of `low`, halfway between two scores; of several as
    good the lowest. It stays at `start` unless that divides worse by more than one standard error, which small samples may not show."""
    if not low or not high:
        return start
    low, high = sorted(low), sorted(high)
    scores = sorted({*low, *high})

    def gain(score: float) -> float:
        return bisect_left(low, score) / len(low) - bisect_left(high, score) / len(high)

    best = max(range(len(scores)), key=lambda i: gain(scores[i]))
    found = (scores[best - 1] + scores[best]) / 2 if gain(scores[best]) > 0 else -math.inf
    return found if gain(found) - gain(start) > math.sqrt(0.25 / len(low) + 0.25 / len(high)) else start


def limits(docs: DataFrame, labelled: DataFrame, ratios: list[float], markers: dict[str, float], *, place: float = PLACE) -> tuple[float, float]:
    """The score that a document must reach and the toxicity that it must stay below, by the scores of single labelled documents.

    Bad documents had no part in the fit, and are all held out. A kind with no held-out document is judged by its fitted ones.
    Where labels of a kind are missing, or it scores no worse, nothing says what to reject, and no document fails that limit."""
    known = _hashed(computed_once(_known(docs, labelled, "inner"), "words", spaced_words(F.col("text"))))
    scored = known.select("fitted", "good", "bad", "toxic", "clean", (F.size("hashes") + F.size("pairs")).alias("grams"),
                          _score(ratios).alias("score"), _toxicity(markers).alias("toxicity"))
    rows = scored.collect()  # a row a labelled document

    def of(kind: str) -> list:
        return [r for r in rows if r[kind] and not r["fitted"]] or [r for r in rows if r[kind]]

    def mean(found: list) -> float:
        return sum(r["grams"] * r["score"] for r in found) / max(sum(r["grams"] for r in found), 1)

    good, bad, least = of("good"), [r for r in rows if r["bad"]], -math.inf
    if good and bad:
        start = mean(bad) + place * (mean(good) - mean(bad)) if mean(good) > mean(bad) else -math.inf
        least = best_limit([r["score"] for r in bad], [r["score"] for r in good], start)
    most = best_limit([r["toxicity"] for r in of("clean")], [r["toxicity"] for r in of("toxic")])
    return least, most if most > 0 else math.inf


def _counts(words: Column, text: Column, lines: Column) -> dict[str, Column]:
    symbols = [F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in SYMBOLS]
    # Most texts repeat no line; only the others have to be asked which of their lines have a word.
    worded = F.filter(lines, lambda line: F.trim(line, F.lit(BLANKS)) != "")
    repeats = F.size(F.array_distinct(lines)) < F.size(lines)
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": sum(symbols, F.lit(0)).cast("bigint"),
        "n_dup_lines": F.when(repeats, F.size(worded) - F.size(F.array_distinct(worded))).otherwise(0).cast("bigint"),
    }


def _repeated_places(placed: Column) -> Column:
    """In order, the starts of windows that occur more than once, from (hash, place) pairs in order: equal hashes are neighbours."""
    pairs = F.zip_with(
        placed, F.slice(placed, 2, F.greatest(F.size(placed) - 1, F.lit(0))),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    return F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))


def _covered(places: Column) -> Column:
    """Words in the windows that start at `places`: each window adds those that the next one does not cover."""
    steps = F.zip_with(
        places, F.slice(places, 2, F.greatest(F.size(places) - 1, F.lit(0))),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(REPEAT_WINDOW)), F.lit(REPEAT_WINDOW)),
    )
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)


def rule_counts(docs: DataFrame, *, text_column: str = "text") -> DataFrame:
    """(row, hashes, pairs, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) for every row; `row` is the row itself."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = computed_once(docs.select(packed(docs), text.alias("text")), "words", spaced_words(F.col("text")))
    rows = computed_once(rows, "lines", F.split("text", "\n"))
    counts = _counts(F.col("words"), F.col("text"), F.col("lines"))
    rows = _hashed(rows.select("row", *[c.alias(n) for n, c in counts.items()], "words"))
    # A window of three words is two pairs.
    rows = computed_once(rows, "windows", _neighbours(F.col("pairs")))
    # Most documents repeat no window, and a set tells that faster than sorting.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = computed_once(rows, "placed", F.when(repeats, placed)).drop("windows")
    rows = computed_once(rows, "places", F.when(F.col("placed").isNotNull(), _repeated_places(F.col("placed")))).drop("placed")
    covered = F.when(F.col("places").isNotNull(), _covered(F.col("places"))).otherwise(F.lit(0))
    return computed_once(rows, "n_repeat_words", covered.cast("bigint")).drop("places")


def quality_rules(
    docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", buckets: int = BUCKETS,
    sample: int = SAMPLE, smoothing: float = SMOOTHING, place: float = PLACE, markers: int = MARKERS,
) -> DataFrame:
    """`row` (the columns of `docs`) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, toxicity, base_failed and kept.

    base_failed: fewer than 50 words, or more than half of the words in repeated windows of three. The score is the mean log
    ratio of a document's n-grams, 0 without words; toxicity is that of its marker words, 0 without any. kept means that base
    rules hold, the score reaches its limit and toxicity stays below its own. Null texts have no words and fail; rows that repeat
    count each time; rows without an id are never part of the labelled sample. Without labels of both kinds only the base rules
    decide. No rows: no rows.
    """
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    labelled = cut_lineage(labelled_sample(labels, sample))
    ratios = fit(bucket_counts(texts, labelled, buckets=buckets), buckets=buckets, smoothing=smoothing)
    marks = toxic_markers(texts, labelled, markers=markers)
    least, most = limits(texts, labelled, ratios, marks, place=place)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = computed_once(rule_counts(docs, text_column=text_column), "score", _score(ratios))
    scored = computed_once(scored, "toxicity", _toxicity(marks)).drop("hashes", "pairs").withColumn("base_failed", failed)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(least)) & (F.col("toxicity") < F.lit(most)))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that quality_rules keeps, as they were."""
    return quality_rules(docs, labels, **options).where("kept").select("row.*")
