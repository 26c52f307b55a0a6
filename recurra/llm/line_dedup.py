"""Line dedup: lines that repeat, word for word or but for one word, are kept only where they come first.

Near lines are found by a deletion-neighbourhood join. The edit bound is one word: every line is emitted once whole and once
without each of its words, as a hashed key. Two lines are one substitution apart if they agree without the word at the same
place, and one insertion apart if one of them whole is the other without a word. Of all lines under a key only the earliest
matters to the others, so a key gives each of its lines at most one partner and never a pair of every two. Partners are verified
on the words themselves.

Only lines that can have a partner are emitted at all, and only without words where the edit can be: one edit leaves the first or
the last words of a line as they were, so a line whose beginning and end are found in no other line of such a length has no partner.
Which of them are shared is told in two steps. A bit map that grows with their number says which lines are worth moving; of those the
halves are compared themselves. A bit that is set by chance moves a line once, it never makes keys nor changes a result. Everything is
built of DataFrame functions.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.llm.common import BLANKS, all_columns, computed_once, packed
from recurra.session import cut_lineage

# One word of five is a fifth: shorter lines that differ in a word are not four fifths alike, and repeat only if they are equal.
MIN_NEAR_WORDS = 5
# Bits of the map of shared halves at least, and bits for each of them, of which it sets BITS_SET in one number of 64. Every executor
# gets the map, so it stops at 64 MB (some 30 million shared halves); beyond that more lines move in vain.
MAP_BITS = 1 << 22
MAX_MAP_BITS = 1 << 29
BITS_A_HALF = 16
BITS_SET = 3
# Numbers in a row of the map.
ROW_NUMBERS = 16


def _with_lines(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, text_hash, line_no, line, n) of every line that has a word: its words with one blank between them, and how many."""
    text = F.col(text_column)
    lines = docs.where(text.isNotNull()).select(
        F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n")).alias("line_no", "raw")
    )
    # Nearly all white space is single blanks already, and looking for other is faster than the pattern.
    trimmed = F.trim("raw", F.lit(BLANKS))
    uneven = reduce(Column.__or__, [F.contains(F.col("raw"), F.lit(gap)) for gap in ("  ", *BLANKS.replace(" ", "").replace("\n", ""))])
    even = F.when(uneven, F.regexp_replace(trimmed, r" [ \t-\r]+|[\t-\r][ \t-\r]*", " ")).otherwise(trimmed)
    lines = computed_once(lines, "line", even).drop("raw")
    blanks = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit("")))
    return lines.where("line <> ''").withColumn("n", blanks + 1)


def _line_key() -> list[Column]:
    """A line's name: its hash, and its words and bytes in one number."""
    extent = F.shiftleft(F.col("n").cast("bigint"), 32) + F.octet_length("line")
    return [F.xxhash64("line").alias("hash"), extent.alias("extent")]


def _cuts() -> list[tuple[Column, Column]]:
    """(b, cut) of the classes that a line of n words is in. Class b has lines of 2b - 1, 2b and 2b + 1 words, so two lines one edit
    apart have a class in common. Of their b - 1 first and b last words one edit changes either none of the first (from place `cut`
    on) or none of the last (before it). Lines of an even number of words are in one class only, and so are the shortest."""
    n = F.col("n")
    longer = F.shiftright(n + 1, 1)
    shorter = F.when((n % 2 == 1) & (n > MIN_NEAR_WORDS), F.shiftright(n, 1))
    return [(b, b - 1) for b in (longer, shorter)]


def _halves() -> list[Column]:
    """Hashes of the first and the last words of `line` for each of its classes; null where it is in one class only or too short."""
    near = F.col("n") >= MIN_NEAR_WORDS
    line, blank = F.col("line"), F.lit(" ")
    found = []
    for b, cut in _cuts():
        for end, length in (("first", cut), ("last", -b)):
            half = F.xxhash64(F.lit(end), b, F.call_function("substring_index", line, blank, length))
            found.append(F.when(near & b.isNotNull(), half))
    return found


def _shared(halves: DataFrame) -> DataFrame:
    """(half) of those that two different lines have. `halves` is (half, hash)."""
    return halves.groupBy("half").agg(F.min("hash").alias("low"), F.max("hash").alias("high")).where("low <> high").select("half")


def shared_halves(lines: DataFrame) -> DataFrame:
    halves = lines.where(F.col("n") >= MIN_NEAR_WORDS).select(F.xxhash64("line").alias("hash"), F.explode(F.array(*_halves())).alias("half"))
    return cut_lineage(_shared(halves.where("half is not null")))


def _bits(half: Column, rows: int) -> tuple[Column, Column, Column]:
    """The row of the map that a half is in, the number in that row, and its bits in that number."""
    more, one = F.xxhash64(half), F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftright(more, 6 * k).bitwiseAND(63).cast("int")) for k in range(BITS_SET)]
    number = F.shiftrightunsigned(half, 48).bitwiseAND(ROW_NUMBERS - 1).cast("int")
    return half.bitwiseAND(rows - 1), number, reduce(Column.bitwiseOR, bits)


def map_rows(halves: int, map_bits: int) -> int:
    """How many rows the map has for so many shared halves: a power of two."""
    bits = max(map_bits, min(halves * BITS_A_HALF, MAX_MAP_BITS))
    return 1 << (math.ceil(bits / (64 * ROW_NUMBERS)) - 1).bit_length()


def with_candidates(lines: DataFrame, shared: DataFrame, map_bits: int = MAP_BITS) -> DataFrame:
    """`lines` with a column `candidate`: true for all that have a half which `shared` has, and for a few others."""
    rows = map_rows(shared.count(), map_bits)
    row, number, bits = _bits(F.col("half"), rows)
    marks = shared.select(row.alias("row"), number.alias("number"), bits.alias("bits"))
    numbers = [F.coalesce(F.bit_or(F.when(F.col("number") == k, F.col("bits"))), F.lit(0).cast("bigint")) for k in range(ROW_NUMBERS)]
    table = cut_lineage(marks.groupBy("row").agg(F.array(*numbers).alias("numbers")))
    names, halves = all_columns(lines), _halves()
    found = lines.select(*names, *[half.alias(f"half{k}") for k, half in enumerate(halves)])
    is_set = []
    for k in range(len(halves)):
        row, number, bits = _bits(F.col(f"half{k}"), rows)
        part = table.select(F.col("row").alias(f"row{k}"), F.col("numbers").alias(f"numbers{k}"))
        found = found.join(F.broadcast(part), row == F.col(f"row{k}"), "left")
        is_set.append(F.coalesce(F.get(f"numbers{k}", number).bitwiseAND(bits) == bits, F.lit(False)))
    return found.select(*names, reduce(Column.__or__, is_set).alias("candidate"))


def _with_shared_ends(lines: DataFrame) -> DataFrame:
    """The lines that have a half in common with another of `lines`, with `ends`: a bit for each of their halves, set if it is shared."""
    halves = lines.withColumn("n", F.shiftright("extent", 32).cast("int"))
    halves = halves.select("hash", "extent", F.posexplode(F.array(*_halves())).alias("end", "half")).where("half is not null")
    bit = F.call_function("shiftleft", F.lit(1), F.col("end"))
    ends = halves.join(_shared(halves), "half").groupBy("hash", "extent").agg(F.bit_or(bit).alias("ends"))
    return lines.join(ends, ["hash", "extent"])


def _may_be_edited() -> Column:
    """Whether the edit may be at a place: after first words that are shared or before last ones."""
    n_th = enumerate([after for _, cut in _cuts() for after in (F.col("place") >= cut, F.col("place") < cut)])
    return reduce(Column.__or__, [(F.col("ends").bitwiseAND(1 << k) != 0) & there for k, there in n_th])


def _variants(lines: DataFrame) -> DataFrame:
    """(variant, length, place, hash, extent): every line whole (place -1) and without each of the words that its `ends` allow.

    A sequence's key is the xor of hashes of its words with their places. Running sums along the line give the key without any
    one word, so a line of n words costs n steps. Lines are dealt out whole, before their words are taken apart.
    """
    n = F.shiftright("extent", 32).cast("int").alias("n")
    placed = lines.select("hash", "extent", "ends", "line").repartition("hash", "extent").select(
        "hash", "extent", "ends", n, F.posexplode(F.split("line", " ")).alias("place", "word")
    )
    placed = placed.select(
        "hash", "extent", "ends", "n", "place", F.xxhash64("word", "place").alias("here"), F.xxhash64("word", F.col("place") - 1).alias("moved"),
    )
    line = Window.partitionBy("hash", "extent")
    along = line.orderBy("place")
    zero = F.lit(0).cast("bigint")
    before = F.coalesce(F.bit_xor("here").over(along.rowsBetween(Window.unboundedPreceding, -1)), zero)
    through = F.bit_xor("moved").over(along.rowsBetween(Window.unboundedPreceding, 0))
    summed = placed.select(
        "hash", "extent", "ends", "n", "place", before.alias("before"), through.alias("through"), "here",
        F.bit_xor("moved").over(line).alias("all_moved"),
    )
    without = F.struct(
        F.col("before").bitwiseXOR(F.col("all_moved")).bitwiseXOR(F.col("through")).alias("variant"),
        (F.col("n") - 1).alias("length"), F.col("place").alias("place"),
    )
    whole = F.struct(F.col("before").bitwiseXOR(F.col("here")).alias("variant"), F.col("n").alias("length"), F.lit(-1).alias("place"))
    last, edited = F.col("place") == F.col("n") - 1, _may_be_edited()
    emitted = F.when(last & edited, F.array(without, whole)).when(last, F.array(whole)).when(edited, F.array(without))
    return summed.select("hash", "extent", F.inline(emitted))


def _partners(lines: DataFrame) -> DataFrame:
    """(hash, extent, place, p_place, first): for a line under one of its keys the earliest line that may be one edit away."""
    variants = _variants(lines)
    keys = ["variant", "length"]
    shared = (
        variants.groupBy(*keys).agg(F.min("hash").alias("low"), F.max("hash").alias("high")).where("low <> high").select(*keys)
    )
    ordered = lines.select("hash", "extent", "first")
    mine = cut_lineage(variants.join(shared, keys).join(ordered, ["hash", "extent"]))
    by_place = mine.groupBy(*keys, "place").agg(F.min("first").alias("earliest"))
    by_kind = by_place.groupBy(*keys).agg(
        F.min(F.when(F.col("place") < 0, F.col("earliest"))).alias("whole"),
        F.min(F.when(F.col("place") >= 0, F.struct("earliest", "place"))).alias("shortened"),
    )
    substituted = mine.where("place >= 0").join(by_place.withColumnRenamed("earliest", "partner"), [*keys, "place"]).select(
        "hash", "extent", "first", "place", F.col("place").alias("p_place"), "partner"
    )
    kinds = mine.join(by_kind, keys)
    longer = kinds.where("place >= 0 and whole is not null").select("hash", "extent", "first", "place", F.lit(-1).alias("p_place"), F.col("whole").alias("partner"))
    shorter = kinds.where("place < 0 and shortened is not null").select(
        "hash", "extent", "first", "place", F.col("shortened.place").alias("p_place"), F.col("shortened.earliest").alias("partner")
    )
    return reduce(DataFrame.union, (substituted, longer, shorter)).where("partner < first")


def _without(words: Column, place: Column) -> Column:
    """The words without the one at a place; all of them for place -1."""
    cut = F.concat(F.slice(words, 1, F.greatest(place, F.lit(0))), F.slice(words, place + 2, F.size(words)))
    return F.when(place < 0, words).otherwise(cut)


def near_lines(lines: DataFrame) -> DataFrame:
    """(hash, extent) of lines that have an earlier line one edit away. `lines` is (hash, extent, first, line), each line once.

    Lines move whole and are split where they arrive: as arrays of words they take about three times the room. Only those that share
    a half with another one do."""
    lines = cut_lineage(_with_shared_ends(lines))
    pairs = _partners(lines).distinct()
    partner = lines.select(F.col("first").alias("partner"), F.col("line").alias("p_line"))
    both = pairs.join(lines.select("hash", "extent", "line"), ["hash", "extent"]).join(partner, "partner")
    both = computed_once(computed_once(both, "words", F.split("line", " ")), "p_words", F.split("p_line", " "))
    equal = _without(F.col("words"), F.col("place")) == _without(F.col("p_words"), F.col("p_place"))
    return both.where(equal).select("hash", "extent").distinct()


def judged_lines(lines: DataFrame, *, map_bits: int = MAP_BITS) -> DataFrame:
    """(hash, extent, first, is_near) of the lines that have more places than one or an earlier line one edit away. Nothing of any
    other line goes, so those need not meet their places again. `lines` is (id, text_hash, line_no, line, n)."""
    lines = with_candidates(lines, shared_halves(lines), map_bits)
    places = lines.select(_place().alias("here"), *_line_key(), F.when(F.col("candidate"), F.col("line")).alias("line"))
    found = [F.min("here").alias("first"), F.any_value("line").alias("line"), (F.count("*") > 1).alias("again")]
    distinct = cut_lineage(places.groupBy("hash", "extent").agg(*found).where("line is not null or again"))
    near = cut_lineage(near_lines(distinct.where("line is not null").drop("again"))).withColumn("is_near", F.lit(True))
    return distinct.drop("line").join(near, ["hash", "extent"], "left").where("again or is_near").drop("again")


def _place() -> Column:
    """Where a line stands, in the order of places."""
    return F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "line_no")


def repeated_lines(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", map_bits: int = MAP_BITS) -> DataFrame:
    """(id, text_hash, dropped, n_exact, n_near): the 0-based numbers of the lines to drop of every document that has any.

    Of an exact repeat only the first place stays, of a near one also goes the first place if an earlier line is one edit away.
    """
    lines = _with_lines(docs, id_column, text_column)
    judged = judged_lines(lines, map_bits=map_bits)
    here = lines.select("id", "text_hash", "line_no", *_line_key()).join(judged, ["hash", "extent"])
    is_repeat = _place() != F.col("first")
    return here.where(is_repeat | F.col("is_near")).groupBy("id", "text_hash").agg(
        F.collect_set("line_no").alias("dropped"),
        F.count_if(is_repeat).alias("n_exact"), F.count_if(~is_repeat).alias("n_near"),
    )


def dedup_lines(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", map_bits: int = MAP_BITS) -> DataFrame:
    """`row` (the columns of `docs`), n_lines, n_exact, n_near and kept_text.

    Lines end at \\n and are compared by their blank-separated words. A line of any length repeats if it is equal, one of five
    words or more also if it is near; lines without a word stay. Lines may be as long as texts are: a line of n words has n + 1 keys,
    each in a row of its own. "Earlier" is the order of id, then a hash of the text, then the line; rows without an id come last. Rows that
    share id and text are one document: their lines are each other's places, and they get the same result. A null text has no
    lines and stays null; a text all of whose lines go becomes empty. No rows: no rows.
    """
    dropped = repeated_lines(docs, id_column=id_column, text_column=text_column, map_bits=map_bits).select(
        F.struct("id", "text_hash").alias("of"), "dropped", "n_exact", "n_near"
    )
    key = F.struct(F.col(id_column).alias("id"), F.xxhash64(F.col(text_column)).alias("text_hash"))
    rows = docs.select(packed(docs), key.alias("key")).join(dropped, F.col("key") == F.col("of"), "left")
    rows = rows.select(
        "row", F.col("row").getField(text_column).alias("text"), "dropped", F.coalesce("n_exact", F.lit(0)).alias("n_exact"), F.coalesce("n_near", F.lit(0)).alias("n_near"),
    )
    split = F.when(F.col("text").isNull(), F.array().cast("array<string>")).otherwise(F.split("text", "\n"))
    lines = computed_once(rows, "lines", split)
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    judged = computed_once(lines, "kept_text", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept))
    return judged.select("row", F.size("lines").cast("bigint").alias("n_lines"), "n_exact", "n_near", "kept_text")


def without_repeated_lines(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", map_bits: int = MAP_BITS) -> DataFrame:
    """`docs` with the lines gone that dedup_lines drops. Documents of which no word is left go with them."""
    found = dedup_lines(docs, id_column=id_column, text_column=text_column, map_bits=map_bits)
    lost = (F.col("n_exact") + F.col("n_near") > 0) & ~F.col("kept_text").rlike(r"[^\x20\x09-\x0D]")
    columns = [
        F.col("kept_text").alias(name) if name == text_column else F.col("row").getField(name).alias(name) for name in docs.columns
    ]
    return found.where(~lost).select(*columns)
