"""License scans: ordered signature rules over the words of a document.

A text is reduced to its plain words in lower case, each between two blanks, so that a rule's pattern is a run of whole words and two
matches never share a blank. Only documents that have a rule's keyword are matched against it. Detections of one document are
put in order by place; one that lies within another of a better or equal priority is suppressed. Everything is built of DataFrame
functions, in a single pass over the texts; what moves between tasks is detections, not texts.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.llm.common import computed_once

# The base phrases and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Patterns below are written with one blank between words; " ?" is a blank that may be missing.
_VERSION = "(?: version| v)?"

# label, keyword, names. Every match of a name has the keyword in it.
FAMILIES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("mit", "mit", ("mit", "expat mit", "mit x11")),
    ("apache-2", "apache", (rf"apache license{_VERSION} 2(?: 0)?", r"apache(?: software)? license 2(?: 0)?", "apache 2(?: 0)?")),
    ("apache-1.1", "apache", (rf"apache(?: software)? license{_VERSION} 1 1",)),
    ("gpl-3", "gpl", (rf"(?:gnu )?gpl{_VERSION} ?3(?: 0)?", "gplv3")),
    ("gpl-2", "gpl", (rf"(?:gnu )?gpl{_VERSION} ?2(?: 0)?", "gplv2")),
    ("gpl-3", "general", (rf"gnu general public license{_VERSION} 3(?: 0)?",)),
    ("gpl-2", "general", (rf"gnu general public license{_VERSION} 2(?: 0)?",)),
    ("gpl", "general", ("gnu general public license",)),
    ("gpl", "gpl", ("gnu gpl",)),
    ("lgpl-3", "lesser", (rf"gnu lesser general public license{_VERSION} 3(?: 0)?",)),
    ("lgpl-2.1", "lesser", (rf"gnu lesser general public license{_VERSION} 2 1",)),
    ("lgpl", "lesser", ("gnu lesser general public license",)),
    ("lgpl-3", "lgplv3", ("lgplv3",)),
    ("lgpl", "lgpl", ("(?:gnu )?lgpl",)),
    ("agpl-3", "affero", (rf"gnu affero general public license{_VERSION}(?: 3)?(?: 0)?",)),
    ("agpl-3", "agpl", (rf"(?:gnu )?agpl{_VERSION} 3(?: 0)?",)),
    ("gfdl", "documentation", ("gnu free documentation license",)),
    ("bsd-2", "bsd", ("(?:2|two) clause bsd", "bsd (?:2|two) clause", "simplified bsd", "freebsd")),
    ("bsd-3", "bsd", ("(?:3|three) clause bsd", "bsd (?:3|three) clause", "(?:new|modified|revised) bsd")),
    ("bsd-4", "bsd", ("(?:4|four) clause bsd", "bsd (?:4|four) clause", "original bsd")),
    ("bsd", "bsd", ("bsd",)),
    ("isc", "isc", ("isc",)),
    ("mpl-2", "mozilla", (rf"mozilla public license{_VERSION} 2(?: 0)?",)),
    ("mpl-1.1", "mozilla", (rf"mozilla public license{_VERSION} 1 1",)),
    ("mpl-2", "mpl", (rf"mpl{_VERSION} 2(?: 0)?",)),
    ("epl-2", "eclipse", (rf"eclipse public license{_VERSION} 2(?: 0)?",)),
    ("epl-1", "eclipse", (rf"eclipse public license{_VERSION} 1(?: 0)?",)),
    ("cddl-1", "cddl", (rf"cddl{_VERSION} 1 [01]",)),
    ("cddl-1", "distribution", (rf"common development and distribution license{_VERSION}(?: 1 [01])?",)),
    ("artistic-2", "artistic", (rf"artistic license{_VERSION} 2(?: 0)?",)),
    ("artistic-1", "artistic", (rf"artistic license{_VERSION} 1(?: 0)?",)),
    ("zlib", "zlib", ("zlib(?: libpng)?",)),
    ("boost-1", "boost", (rf"boost software license{_VERSION}(?: 1)?(?: 0)?",)),
    ("unlicense", "unlicense", ("unlicense",)),
    ("wtfpl", "wtfpl", ("wtfpl",)),
    ("postgresql", "postgresql", ("postgresql",)),
    ("python-2", "python", ("python software foundation", "psf python", "python 2 0")),
    ("openssl", "openssl", ("openssl",)),
    ("ofl-1.1", "sil", ("sil open font",)),
    ("ms-pl", "microsoft", ("microsoft public",)),
    ("ms-rl", "microsoft", ("microsoft reciprocal",)),
    ("eupl-1.2", "eupl", (rf"eupl{_VERSION} 1 2",)),
    ("cecill-2.1", "cecill", (rf"cecill{_VERSION} 2 1",)),
    ("odbl-1", "odbl", ("odbl", rf"odbl{_VERSION} 1 0")),
    ("cc0-1", "cc0", ("cc0(?: 1 0)?", "cc0 universal")),
    ("cc-by-nc-nd", "cc", ("cc by nc nd(?: [1-4] [05])?",)),
    ("cc-by-nc-sa", "cc", ("cc by nc sa(?: [1-4] [05])?",)),
    ("cc-by-nc", "cc", ("cc by nc(?: [1-4] [05])?",)),
    ("cc-by-nd", "cc", ("cc by nd(?: [1-4] [05])?",)),
    ("cc-by-sa", "cc", ("cc by sa(?: [1-4] [05])?",)),
    ("cc-by", "cc", ("cc by(?: [1-4] [05])?",)),
    ("cc-by-nc-nd", "creative", ("creative commons attribution non ?commercial no ?deriv(?:s|atives)",)),
    ("cc-by-nc-sa", "creative", ("creative commons attribution non ?commercial share ?alike",)),
    ("cc-by-nc", "creative", ("creative commons attribution non ?commercial",)),
    ("cc-by-nd", "creative", ("creative commons attribution no ?deriv(?:s|atives)",)),
    ("cc-by-sa", "creative", ("creative commons attribution share ?alike",)),
    ("cc-by", "creative", ("creative commons attribution",)),
)

# priority, a second keyword, what stands around a name. Lower numbers are better evidence.
FORMS: tuple[tuple[int, str, str], ...] = (
    (1, "under", r"(?:is|are) (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{}(?: license)?"),
    (1, "permission", r"permission is hereby granted under (?:the )?{}(?: license)?"),
    (2, "under", r"(?:licensed|released|distributed|published|provided) under (?:the )?(?:terms of )?(?:the )?{}(?: license)?"),
    (2, "licen", r"(?:dual|multi) licensed under (?:the )?{}(?: license)?"),
    (2, "licen", r"(?:spdx )?license identifier {}"),
    (3, "under", r"under (?:the )?(?:terms of )?(?:the )?{} license"),
    (3, "licen", r"license {}"),
    (4, "licen", r"{} licen[cs]ed?"),
    (5, "", r"{}"),
)
# Families whose names say enough alone; each of these names has one of the texts that ALONE lists.
ALONE = ("license", "gpl", "cc", "creative")
_ALONE_FAMILIES = frozenset("gpl general lesser lgpl lgplv3 affero agpl documentation mozilla eclipse distribution cc creative".split())

# Notices that name no license, or quote one's own words.
NOTICES: tuple[tuple[int, str, str, str], ...] = (
    (1, "mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    (1, "isc", "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    (1, "bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    (1, "gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    (1, "lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    (1, "public-domain", "public", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    (2, "public-domain", "public", "in the public domain"),
    (2, "proprietary", "reserved", "all rights reserved"),
    (2, "proprietary", "confidential", "proprietary and confidential"),
    (3, "no-warranty", "warranty", "without warranty of any kind"),
)
# What the strongest remaining detection of a document makes its score.
SCORES = {0: 1.0, 1: 1.0, 2: 0.9, 3: 0.8, 4: 0.7, 5: 0.5}


# A text without any of these can match no rule. Every rule has one of them among its keywords, or a name that ALONE covers.
STEMS = ("licen", "under", "permission", "redistribut", "public", "reserved", "confidential", "warranty", "gpl", "cc", "creative")


@dataclass(frozen=True)
class Rule:
    number: int
    priority: int
    label: str
    keyword: str
    also: str
    pattern: str
    is_base: bool


def _spaced(words: str) -> str:
    """A pattern over words that each stand between two blanks: a blank between two words becomes two."""
    return " " + words.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?") + " "


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in order: base phrases, notices, then every family in every form."""
    found: list[tuple[int, str, str, str, str, bool]] = []
    for phrase, label in BASE_PHRASES:
        found.append((0, label, phrase.split()[-1], "", phrase, True) if label == "cc-by-nc" else (0, label, "license", "", phrase, True))
    for priority, label, keyword, words in NOTICES:
        found.append((priority, label, keyword, "", words, False))
    for label, keyword, names in FAMILIES:
        for priority, also, form in FORMS:
            if priority < 5 or keyword in _ALONE_FAMILIES:
                found += [(priority, label, keyword, also, form.format(name), False) for name in names]
    return tuple(Rule(number, p, label, key, also, _spaced(words), base) for number, (p, label, key, also, words, base) in enumerate(found))


def normalised(text: Column) -> Column:
    """Plain words in lower case, each between two blanks; one blank if there is none."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = F.trim(F.regexp_replace(F.translate(text, upper, lower), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))


def _rule_table() -> Column:
    """The rules as one constant."""
    rows = [
        {"number": r.number, "priority": r.priority, "label": r.label, "keyword": r.keyword, "also": r.also, "pattern": r.pattern, "is_base": r.is_base}
        for r in rules()
    ]
    kind = "array<struct<number:int,priority:int,label:string,keyword:string,also:string,pattern:string,is_base:boolean>>"
    return F.from_json(F.lit(json.dumps(rows)), kind)


def _n_words(part: Column) -> Column:
    return ((F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))) / 2).cast("bigint")


def detections(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(row, id, n_words, number, priority, label, is_base, begin, end): every match of every rule by words, end not in it. `row`
    numbers the rows of `docs`; one without a match has one row without a rule."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("bigint").alias("n_words"), text.alias("text"),
    )
    lower = F.lower("text")
    may_match = reduce(Column.__or__, [F.contains(lower, F.lit(stem)) for stem in STEMS])
    rows = computed_once(rows, "words", F.when(may_match, normalised(F.col("text")))).drop("text")
    keywords = sorted({k for r in rules() for k in (r.keyword, r.also) if k})
    listed = F.split(F.lit(",".join(keywords)), ",")
    rows = computed_once(rows, "found", F.filter(listed, lambda k: F.contains(F.col("words"), k)))
    fitting = F.filter(
        _rule_table(), lambda r: F.array_contains("found", r["keyword"]) & ((r["also"] == "") | F.array_contains("found", r["also"]))
    )
    tried = rows.select("row", "id", "n_words", "words", F.explode_outer(F.when(F.size("found") > 0, fitting)).alias("rule"))
    pattern = F.col("rule.pattern")
    hits = F.regexp_extract_all("words", pattern, F.lit(0))
    matched = computed_once(tried, "hits", F.when(pattern.isNotNull(), hits)).withColumn(
        "between", F.when(F.size("hits") > 0, F.split("words", pattern))
    )
    both = F.arrays_zip(
        F.transform("between", _n_words).alias("gap"), F.transform("hits", _n_words).alias("extent")
    )
    placed = matched.select("row", "id", "n_words", "rule", F.posexplode_outer(F.when(F.size("hits") > 0, both)).alias("turn", "part"))
    # A document that no rule matches keeps one row; one row for each rule that did not match is enough of it.
    placed = placed.select(
        "row", "id", "n_words", F.when(F.col("part.extent").isNotNull(), F.col("rule")).alias("rule"), "turn", "part.gap", "part.extent"
    ).repartition("row")
    before = Window.partitionBy("row", "rule.number").orderBy("turn")
    begin = F.sum("gap").over(before.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce(
        F.sum("extent").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return placed.select(
        "row", "id", "n_words", "rule.number", "rule.priority", "rule.label", "rule.is_base", begin.alias("begin"), (begin + F.col("extent")).alias("end")
    )


def _suppressed(found: DataFrame) -> Column:
    """Whether a detection lies within an earlier one, in the order of place, of a better or equal priority."""
    order = Window.partitionBy("row").orderBy("begin", F.desc("end"), "priority", "number").rowsBetween(Window.unboundedPreceding, -1)
    levels = sorted(SCORES)
    furthest = [F.max(F.when(F.col("priority") <= level, F.col("end"))).over(order) for level in levels]
    reach = reduce(lambda c, pair: c.when(F.col("priority") == pair[0], pair[1]), zip(levels, furthest), F)
    return F.coalesce(reach >= F.col("end"), F.lit(False))


def scan_licenses(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row.

    n_base counts the places of the base phrases; first_word and last_word are where the first and the last of them begin, null
    without any. base_labels are theirs, labels those and the labels of all detections that are not suppressed; both are
    distinct, in order, joined by commas, empty for none. The score tells how strong the best detection is, 0 for none. Null and
    empty texts have no words. Repeated rows are each a row of the result; other columns are not read. No rows: no rows.
    """
    found = detections(docs, id_column=id_column, text_column=text_column)
    judged = found.withColumn("is_kept", F.col("number").isNotNull() & (F.col("is_base") | ~_suppressed(found)))
    score = reduce(lambda c, pair: c.when(F.col("priority") == pair[0], F.lit(pair[1])), SCORES.items(), F)
    names = lambda test: F.array_join(F.array_sort(F.collect_set(F.when(test, F.col("label")))), ",")
    return judged.groupBy("row").agg(
        F.any_value("id").alias(id_column), F.any_value("n_words").alias("n_words"),
        F.count_if(F.col("is_base")).alias("n_base"),
        F.min(F.when(F.col("is_base"), F.col("begin"))).alias("first_word"), F.max(F.when(F.col("is_base"), F.col("begin"))).alias("last_word"),
        names(F.col("is_base")).alias("base_labels"), names(F.col("is_kept")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("is_kept"), score)), F.lit(0.0)).alias("score"),
    ).drop("row")
