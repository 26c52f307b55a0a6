"""Operators on documents, each against a plain Python version on small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from recurra.llm import (
    decontamination,
    gru,
    license_scan,
    line_dedup,
    lm_scoring,
    mixing,
    quality,
    simhash,
    token_counts,
)
from recurra.llm.fm_index import FMIndex
from tests.llm.cases import DOCS, by_id, documents, odd_documents, prose, values

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- op 3

def plain_fingerprint(text, shingle=3):
    words = SPACED.findall(lowered(text))
    shingles = [" ".join(words[i: i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [plain_fingerprint(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[top(i)] = top(j)
    lowest = collections.defaultdict(list)
    for i, r in enumerate(rows):
        lowest[top(i)] += [] if r[0] is None else [r[0]]
    return sorted(((r[0], f"{prints[i]:016x}", min(lowest[top(i)], default=None)) for i, r in enumerate(rows)), key=repr)


def test_simhash_components(spark):
    docs, rows = odd_documents(spark)
    near = [(100 + i, prose(5, 400) + f" tail{i}", "s") for i in range(12)]
    rows = rows + near
    found = simhash.simhash_components(documents(spark, rows))
    assert values(found, "doc_id", "fingerprint", "component_id") == plain_components(rows)


def test_simhash_of_spark_is_xxh64(spark):
    assert spark.sql("SELECT xxhash64('a b c') AS h").first()["h"] % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("max_bits, segments", [(3, 8), (1, 8), (0, 4), (3, 4), (5, 8), (7, 16)])
def test_close_fingerprints_share_a_key(max_bits, segments):
    random.seed(max_bits)
    masks, width = simhash.key_masks(max_bits, segments), 64 // segments
    turned = lambda x, s: (x << s * width | x >> 64 - s * width) & 2**64 - 1 if s else x
    for _ in range(300):
        a = random.getrandbits(64)
        b = a
        for bit in random.sample(range(64), random.randint(0, max_bits)):
            b ^= 1 << bit
        assert any((turned(a, s) ^ turned(b, s)) & m == 0 for s in range(segments) for m in masks)
        assert simhash.within_chains(np.array([a ^ b], np.uint64), max_bits, segments)[0]


@pytest.mark.parametrize("block", [4, 2048])
def test_crowded_keys_lose_no_link(spark, block):
    random.seed(4)
    base = random.getrandbits(64)
    prints = {base}
    for _ in range(80):
        x = random.choice(sorted(prints))
        for bit in random.sample(range(64), 2):
            x ^= 1 << bit
        prints.add(x)
    signed = [(p - 2**64 if p >> 63 else p,) for p in prints]
    from recurra.llm.components import connected_components

    found = connected_components(simhash.links(spark.createDataFrame(signed, "fp bigint"), block=block))
    assert {r["node"] for r in found.collect()} == {s[0] for s in signed}
    assert len({r["root"] for r in found.collect()}) == 1


def test_one_of_each_component(spark):
    docs, rows = odd_documents(spark)
    kept = simhash.one_of_each_component(docs)
    assert kept.columns == docs.columns
    groups = {c for _, _, c in plain_components(rows) if c is not None}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(groups)


# --- op 8

def plain_contamination(rows, items, window=10):
    found = []
    for doc_id, text, *_ in rows:
        words, hit, names = PLAIN.findall(lowered(text)), set(), set()
        for name, item in items:
            own = PLAIN.findall(lowered(item))
            n = min(window, len(own))
            for at in range(len(own) - n + 1 if own else 0):
                for place in range(len(words) - n + 1):
                    if words[place: place + n] == own[at: at + n]:
                        hit |= set(range(place, place + n))
                        names.add("" if name is None else str(name))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        found.append((doc_id, len(words), len(hit), len(names), digest, bool(hit)))
    return sorted(found, key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination(spark, block_bytes):
    docs, rows = odd_documents(spark)
    items = [(1, prose(1, 25)), (2, prose(1, 12)), (10, "0 1 2 3 4 5 6 7 8 9 10"), (3, "a b"), (4, None), (5, ""), (None, "vertical Feed"), (6, prose(9, 40)), (6, prose(9, 40))]
    rows = rows + [(200, f"Before. {prose(1, 25).upper()}! {prose(9, 15)} after", "s"), (201, prose(9, 9), "s")]
    docs = documents(spark, rows, 3)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.find_contamination(docs, benchmark, block_bytes=block_bytes, shard_words=50)
    assert sorted(found.columns) == sorted(docs.columns)
    shown = decontamination.report(found)
    assert values(shown, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == plain_contamination(rows, items)
    plain = docs.select("doc_id", "text")
    clean = decontamination.decontaminate(plain, benchmark, block_bytes=block_bytes)
    assert all(n == 0 for _, _, n, *_ in plain_contamination([(r["doc_id"], r["text"]) for r in clean.collect()], items))
    assert by_id(clean)[200]["text"].startswith("Before.") and by_id(clean)[200]["text"].endswith("after")
    assert by_id(clean)[201]["text"] == prose(9, 9)


def test_passages_are_cut_where_they_are_found(spark):
    docs = documents(spark, [(1, f"Before. {prose(1, 25)} after", "s"), (2, prose(1, 25), "s"), (3, None, "s"), (4, "else", "s")], 2)
    benchmark = spark.createDataFrame([(1, prose(1, 25))], "item_id bigint, text string")
    clean = decontamination.decontaminate(docs, benchmark)
    assert {r["doc_id"]: r["text"] for r in clean.collect()} == {1: "Before.   after", 3: None, 4: "else"}
    # One Python process a task, and no second copy of the text.
    plan = clean._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("MapInArrow") == 1 and "as binary" not in plan


def test_decontamination_without_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.find_contamination(empty, benchmark).count() == 0
    docs, rows = odd_documents(spark)
    kept = decontamination.decontaminate(docs, benchmark)
    assert kept.count() == len(rows) and kept.schema == docs.schema and kept.first()["found"] == "x"


def test_fm_index_finds_every_place():
    random.seed(2)
    for _ in range(30):
        runs = [[random.randint(1, 3) for _ in range(random.randint(1, 25))] for _ in range(random.randint(1, 6))] * random.randint(1, 2)
        text = np.array([x for r in runs for x in [*r, 0]], np.int32)
        index = FMIndex(text, 4)
        for n in (1, 2, 4):
            patterns = np.array([[random.randint(1, 4) for _ in range(n)] for _ in range(12)])
            for p, low, high in zip(patterns, *index.search(patterns)):
                wanted = [i for i in range(len(text) - n + 1) if (text[i: i + n] == p).all()]
                assert sorted(index.locate(np.arange(low, high)).tolist() if high > low else []) == wanted


# --- op 9

def plain_counts(text):
    text = text or ""
    words = SPACED.findall(text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i: i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def labels(spark, good, bad):
    return spark.createDataFrame([(i, 1, 0) for i in good] + [(i, 0, 0) for i in bad], "doc_id bigint, quality int, toxic int")


def test_quality_counts(spark):
    docs, rows = odd_documents(spark)
    rows = rows + [(300, "a# b* " * 40 + "\nx\nx\n \n", "s"), (301, " ".join([*prose(1, 60).split(), *prose(1, 20).split()]), "s")]
    found = quality.quality_rules(documents(spark, rows), labels(spark, [], []))
    got = sorted(
        ((r["row"]["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in found.collect()),
        key=repr,
    )
    assert got == sorted(((r[0], *plain_counts(r[1])) for r in rows), key=repr)
    # Without labels only the base rules decide.
    assert all(r["kept"] == (not r["base_failed"]) for r in found.collect())


def test_quality_score_is_the_mean_log_ratio(spark):
    rows = [(i, prose(i), "s") for i in range(40)] + [(50 + i, " ".join(f"{w}%%%" for w in prose(50 + i).split()), "s") for i in range(20)]
    found = quality.quality_rules(documents(spark, rows), labels(spark, range(30), range(50, 60)), buckets=1024)
    grams = {}
    for doc_id, text, _ in rows:
        w = [x.encode() for x in text.split()]
        chained = [xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42)) for a, b in zip(w, w[1:])]
        hashes = [xxhash.xxh64_intdigest(x, 42) for x in w] + chained
        grams[doc_id] = [h % 1024 for h in hashes]
    raw = collections.Counter(g for v in grams.values() for g in v)
    fitted = [i for i in range(30) if xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42) % 2 == 0]
    good = collections.Counter(g for i in fitted for g in grams[i])
    top, bottom = sum(good.values()) + 1024, sum(raw.values()) + 1024
    ratio = [math.log((good[b] + 1) / top) - math.log((raw[b] + 1) / bottom) for b in range(1024)]
    mean = lambda ids: sum(ratio[g] for i in ids for g in grams[i]) / sum(len(grams[i]) for i in ids)
    low, high = mean(range(50, 60)), mean([i for i in range(30) if i not in fitted])
    limit = low + 0.75 * (high - low)
    for r in found.collect():
        own = grams[r["row"]["doc_id"]]
        assert r["score"] == pytest.approx(sum(ratio[g] for g in own) / len(own))
        assert r["kept"] == (not r["base_failed"] and r["score"] >= limit)
    kept = {r["row"]["doc_id"] for r in found.where("kept").collect()}
    assert set(fitted) <= kept
    assert quality.keep_good(documents(spark, rows), labels(spark, range(30), range(50, 60))).columns == [f.name for f in DOCS]


def test_toxic_text_of_good_quality_goes(spark):
    def toxic(i):
        return " ".join(w if k % 9 else ("Moron,", "SCUM", "trash!")[(i + k // 9) % 3] for k, w in enumerate(prose(i - 100).split()))

    rows = [(i, prose(i), "s") for i in range(60)] + [(100 + i, toxic(100 + i), "s") for i in range(40)]
    marked = [(i, 1, 0) for i in range(40)] + [(100 + i, 1, 1) for i in range(30)] + [(100, None, 1)]
    found = quality.quality_rules(documents(spark, rows), spark.createDataFrame(marked, "doc_id bigint, quality int, toxic int"))
    assert {r["row"]["doc_id"] for r in found.where("kept").collect()} == set(range(60))
    # Toxic labels alone say nothing of what is clean.
    alone = quality.keep_good(documents(spark, rows), spark.createDataFrame(marked[40:], "doc_id bigint, quality int, toxic int"))
    assert alone.count() == len(rows)


def test_limit_divides_documents_not_means():
    # The worst of the low scores pulls their mean far down: three quarters of the way up leaves most of them.
    low, high = [-3.0, -0.2, -0.15, -0.12] * 5, [-0.04, 0.0, 0.1] * 5
    assert quality.best_limit(low, high, -0.25) == pytest.approx(-0.08)
    # What single documents cannot show to be better stays.
    assert quality.best_limit([0.0, 0.1, 0.3], [0.2, 0.4], 0.35) == 0.35
    assert quality.best_limit([1.0], [0.0]) == quality.best_limit([], [1.0]) == quality.best_limit([0.0], [0.0]) == -math.inf


def test_quality_of_no_documents(spark):
    assert quality.quality_rules(spark.createDataFrame([], DOCS), labels(spark, [1], [2])).count() == 0


# --- op 1

def plain_dedup(rows, min_near=5):
    seen, long, out = {}, [], {}

    def near(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        kept, exact, close = [], 0, 0
        for line in (text or "").split("\n"):
            words = tuple(SPACED.findall(line))
            if not words:
                kept.append(line)
            elif words in seen:
                exact += 1
            else:
                seen[words] = True
                is_near = len(words) >= min_near and any(near(words, other) for other in long)
                long += [words] if len(words) >= min_near else []
                close += is_near
                kept += [] if is_near else [line]
        out[doc_id] = (exact, close, None if text is None else "\n".join(kept))
    return out


def test_line_dedup(spark):
    random.seed(5)
    base = [prose(s, 12).split() for s in range(6)] + [[f"u{s}"] * 11 for s in range(2)]
    lines = []
    for words in base:
        for _ in range(6):
            changed = list(words)
            for _ in range(random.randint(0, 2)):
                at = random.randrange(len(changed))
                kind = random.randint(0, 2)
                changed[at: at + (kind < 2)] = [] if kind == 0 else [random.choice(["new", "u0", "the3"])]
            lines.append(random.choice([" ", "  ", "\t"]).join(changed))
    lines += ["short line", "five words are just enough", "five words  are just enough", "", "   "]
    lines += ["All rights reserved.", "one word", "one wort", "six words that differ in one", "six words that vary in one", "six words that vary in"]
    lines += ["\u4e00\u884c\u6ca1\u6709\u7a7a\u683c" * 5, "a\rb\x0bc\x0c  d", "a b c d", " lone "]
    rows = [(i, "\n".join(random.sample(lines, 8)), "s") for i in range(25)] + [(90, None, "s"), (91, "", "s"), (92, "y " * 400, "s"), (93, "y " * 399, "s")]
    docs = documents(spark, rows, 3)
    found = {r["row"]["doc_id"]: (r["n_exact"], r["n_near"], r["kept_text"]) for r in line_dedup.dedup_lines(docs, map_bits=1 << 12).collect()}
    assert found == plain_dedup(rows)
    kept = line_dedup.without_repeated_lines(docs)
    assert kept.columns == docs.columns
    gone = set(found) - {r["doc_id"] for r in kept.collect()}
    assert gone == {i for i, (e, n, t) in found.items() if e + n and not SPACED.search(t)}


def test_only_lines_that_may_go_meet_their_places_again(spark):
    alone = [prose(s, 9) for s in range(40)]
    near = "six words that differ in one"
    rows = [(i, f"{line}\nthe same\n", "s") for i, line in enumerate(alone)] + [(90, near, "s"), (91, near.replace("one", "two"), "s")]
    lines = line_dedup._with_lines(documents(spark, rows, 3), "doc_id", "text")
    judged = line_dedup.judged_lines(lines, map_bits=1 << 12).collect()
    assert sorted((r["first"]["id"], r["first"]["line_no"], r["is_near"]) for r in judged) == [(0, 1, None), (91, 0, True)]


def test_near_lines_move_whole(spark):
    lines = spark.createDataFrame([(1, 5 << 32, 0, "a b c d e"), (2, 5 << 32, 1, "a b c d f")], "hash bigint, extent bigint, first int, line string")
    # `first` is compared only; any ordered type will do.
    found = line_dedup.near_lines(lines)
    assert [r["hash"] for r in found.collect()] == [2]
    plan = found._jdf.queryExecution().explainString(found.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moved = re.findall(r"\) Exchange.*\n(?:Output.*\n)?Input \[\d+\]: (.*)", plan)
    assert any("line#" in m for m in moved) and not any("words#" in m for m in moved)


def test_only_lines_with_a_shared_end_are_moved_and_get_keys(spark, monkeypatch):
    alone = [prose(s, 9) for s in range(300)]
    near = [prose(s, 9) for s in range(300, 340)]
    texts = alone + near + [line.rsplit(" ", 1)[0] + " other" for line in near]
    lines = line_dedup._with_lines(documents(spark, [(i, t, "s") for i, t in enumerate(texts)], 3), "doc_id", "text")
    near_lines, variants, moved, with_keys = line_dedup.near_lines, line_dedup._variants, [], []

    def moves(lines):
        moved.append(lines.count())
        return near_lines(lines)

    def makes_keys(lines):
        with_keys.append(lines.count())
        return variants(lines)

    monkeypatch.setattr(line_dedup, "near_lines", moves)
    monkeypatch.setattr(line_dedup, "_variants", makes_keys)
    # A map of one number at first, as small beside these lines as the usual one beside a large table.
    judged = line_dedup.judged_lines(lines, map_bits=64).collect()
    assert sorted(r["first"]["id"] for r in judged if r["is_near"]) == list(range(340, 380))
    assert moved[0] < 100 and with_keys == [80]
    # A map that cannot grow moves lines in vain, but makes no keys of them.
    monkeypatch.setattr(line_dedup, "MAX_MAP_BITS", 64)
    monkeypatch.setattr(line_dedup, "ROW_NUMBERS", 1)
    judged = line_dedup.judged_lines(lines, map_bits=64).collect()
    assert sorted(r["first"]["id"] for r in judged if r["is_near"]) == list(range(340, 380))
    assert moved[1] > 200 and with_keys == [80, 80]


def test_map_of_shared_halves_grows_up_to_a_size():
    bits = 64 * line_dedup.ROW_NUMBERS
    assert line_dedup.map_rows(0, 1) == 1 and line_dedup.map_rows(0, 1 << 22) * bits == 1 << 22
    assert line_dedup.map_rows(10**6, 1 << 12) * bits == 1 << 24
    assert line_dedup.map_rows(10**12, 1 << 12) * bits == line_dedup.MAX_MAP_BITS


def test_an_edit_at_any_place_of_any_line_is_found(spark):
    lines = []
    for n in range(4, 14):
        for at in range(n):
            for kind in range(3):
                # Each pair is of words of its own, so that it is found by itself or not at all.
                words = [f"w{n}x{at}x{kind}x{i}" for i in range(n)]
                changed = words[:at] + [[], ["new"], ["new", words[at]]][kind] + words[at + 1:]
                lines += [" ".join(words), " ".join(changed)]
    order = list(range(len(lines)))
    random.Random(3).shuffle(order)
    rows = [(i, lines[k], "s") for i, k in enumerate(order)]
    found = {r["row"]["doc_id"]: (r["n_exact"], r["n_near"], r["kept_text"]) for r in line_dedup.dedup_lines(documents(spark, rows, 3)).collect()}
    assert found == plain_dedup(rows)
    assert sum(near for _, near, _ in found.values()) > 200


def test_line_dedup_of_odd_documents(spark):
    docs, rows = odd_documents(spark)
    found = line_dedup.dedup_lines(docs)
    assert found.count() == len(rows)
    assert line_dedup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


# --- op 4

def plain_licenses(text):
    words = PLAIN.findall(lowered(text))
    places = [
        (i, label) for phrase, label in license_scan.BASE_PHRASES for i in range(len(words))
        if words[i: i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_license_scan(spark):
    docs, rows = odd_documents(spark)
    rows = rows + [
        (400, "under the MIT license under the mit license, cc-by-nc CC BY NC", "s"),
        (401, "This work is licensed under the GNU General Public License, version 3.", "s"),
        (402, "SPDX-License-Identifier: Apache-2.0", "s"), (403, "Licensed under CC BY-NC 4.0.", "s"), (404, "mit freundlichen grüßen under", "s"),
        (405, "Apache License, Version 2.0, January 2004", "s"), (406, "apache license version 2x", "s"),
    ]
    found = license_scan.scan_licenses(documents(spark, rows))
    assert values(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(
        ((r[0], *plain_licenses(r[1])) for r in rows), key=repr
    )
    names = {r["doc_id"]: (r["labels"], r["score"]) for r in found.collect()}
    assert names[401] == ("gpl-3", 1.0) and names[402] == ("apache-2", 0.9) and names[403] == ("cc-by-nc", 1.0)
    assert names[404] == ("", 0.0) and names[400] == ("cc-by-nc,mit", 1.0) and names[405][0] == "apache-2"
    assert license_scan.scan_licenses(spark.createDataFrame([], DOCS)).count() == 0


def test_every_rule_can_pass_its_gates():
    for rule in license_scan.rules():
        assert any(s in rule.pattern or s in rule.keyword for s in license_scan.STEMS), rule
        re.compile(rule.pattern)
    assert len(license_scan.rules()) > 300


# --- op 6

def test_base_scores_and_proper_probabilities(spark):
    docs, rows = odd_documents(spark)
    rows = [r for r in rows if r[0] is not None] + [(500 + i, prose(i), "s") for i in range(10)]
    found = lm_scoring.score_documents(documents(spark, rows), frequent=20, model_words=8, classes=3, hidden=4)
    counts = collections.Counter()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    tokens = lambda t: [*SPACED.findall(lowered(t)), "\0end"]
    for i, t, *_ in rows:
        if not held(i):
            counts.update(tokens(t))
    total, types = sum(counts.values()), len(counts)
    wanted = sorted((i, held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total) for i, t, *_ in rows)
    assert values(found, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens") == sorted(wanted, key=repr)
    texts = {r[0]: r[1] for r in rows}
    for r in found.collect():
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in tokens(texts[r["doc_id"]])))
        assert r["score"] < 0
    assert lm_scoring.score_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_untrained_model_is_the_unigram_model_and_training_helps():
    random.seed(1)
    counts = np.array([50.0, 30, 20, 10, 5, 5])
    bounds = gru.class_bounds(counts, 3)
    start = gru.initial(counts, bounds, 8)
    for name in ("classes", "words"):
        getattr(start, name)[:] = 0
    model = gru.Model(start, bounds)
    text = np.array([0, 1, 2, 3] * 200, np.int32)
    totals = np.zeros(2)
    model.score(iter([(0, text), (1, np.array([5], np.int32))]), totals, 4, 8)
    share = np.log((counts + 1) / (counts + 1).sum())
    assert totals[0] == pytest.approx(share[text].sum(), rel=1e-4) and totals[1] == pytest.approx(share[5], rel=1e-4)
    learned = gru.Model(gru.initial(counts, bounds, 8), bounds)
    for _ in range(30):
        learned.train(iter([(i, text) for i in range(8)]), 0.2, None, 4, 8)
    better = np.zeros(1)
    learned.score(iter([(0, text)]), better, 4, 8)
    assert better[0] > 0.5 * totals[0]


def test_windows_and_lanes_do_not_change_scores():
    counts = np.array([9.0, 7, 5, 3])
    bounds = gru.class_bounds(counts, 2)
    model = gru.Model(gru.initial(counts, bounds, 5), bounds)
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 4, n).astype(np.int32) for n in (1, 40, 3, 17, 64)]
    results = []
    for width, window in ((1, 64), (2, 4), (8, 5)):
        totals = np.zeros(len(texts))
        model.score(iter(enumerate(texts)), totals, width, window)
        results.append(totals)
    assert np.allclose(results[0], results[1], rtol=1e-4) and np.allclose(results[0], results[2], rtol=1e-4)


def test_gradients_agree_with_differences():
    counts = np.array([9.0, 7, 5, 3])
    bounds = gru.class_bounds(counts, 2)
    start = gru.initial(counts, bounds, 3)
    start = gru.Parameters(*[a.astype(np.float64) for a in start.arrays()])
    words = np.array([[0, 1], [2, 3], [1, 0], [3, 3]])
    starts = np.zeros(words.shape, bool)
    starts[0] = True

    def loss(p):
        model = gru.Model(p, bounds)
        keep, _, _ = model.forward(words, starts, np.zeros((2, 3)), np.full(2, -1))
        return -model.log_probabilities(keep["state"].reshape(-1, 3).astype(np.float64), words.ravel())[0].sum()

    model, gradient = gru.Model(start, bounds), start.zeros()
    keep, _, _ = model.forward(words, starts, np.zeros((2, 3)), np.full(2, -1))
    _, back = model.log_probabilities(keep["state"].reshape(-1, 3).astype(np.float64), words.ravel(), gradient)
    model.backward(keep, back.reshape(4, 2, 3), starts, gradient)
    for array, found in zip(start.arrays(), gradient.arrays()):
        for place in [tuple(s // 2 for s in array.shape), tuple(0 for _ in array.shape)]:
            kept = array[place]
            array[place] = kept + 1e-3
            high = loss(start)
            array[place] = kept - 1e-3
            low = loss(start)
            array[place] = kept
            assert found[place] == pytest.approx((high - low) / 2e-3, abs=2e-3)


# --- op 7

def test_token_counts(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = str(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json"))
    library = tokenizers.Tokenizer.from_file(path)
    docs, rows = odd_documents(spark)
    random.seed(6)
    rows = rows + [(600 + i, "".join(random.choice("aeiou bst\n'12é漢😀") for _ in range(300)), "s") for i in range(30)]
    rows += [(700, "<|endoftext|>" * 3 + "x", "s"), (701, "ab" * 20000, "s")]
    found = token_counts.count_tokens(documents(spark, rows), path)
    wanted = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows), key=repr)
    assert values(found, "doc_id", "n_bytes", "n_tokens") == wanted
    assert {r["over_limit"] == (r["n_tokens"] > 1024) for r in found.collect()} == {True}
    assert token_counts.count_tokens(spark.createDataFrame([], DOCS), path).count() == 0


# --- op 10

def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, stop, target, open_ = 1.5 * sum(sizes.values()), {s: 2.0 * n for s, n in sizes.items()}, {}, set(order)
    while open_:
        rate = (budget - sum(stop[s] for s in order if s not in open_)) / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * rate > stop[s]}
        if not over:
            break
        open_ -= over
    for s in order:
        target[s] = weight[s] * rate if s in open_ else stop[s]
    return target


def test_mixing(spark):
    random.seed(8)
    rows = [(i, "w " * random.randint(0, 60), random.choice(["a", "b", "ä", "Z", "c"])) for i in range(300)]
    rows += [(1000 + i, "w " * 7, "hot") for i in range(200)] + [(2000, None, None), (2001, "x y", None), (2002, "", "void"), rows[0], rows[0], (None, "n n", "a")]
    docs = documents(spark, rows)
    found = mixing.mix(docs, ranked_together=16).collect()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    target = plain_targets(sizes)
    taken = collections.Counter()
    for r in found:
        assert r["size"] * 2 >= r["taken"] >= 0 and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["taken"]
    assert len(found) == len(rows)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 7 if s == "hot" else abs(taken[s] - target[s]) <= 1.5, s
    again = mixing.mix(docs.repartition(5), ranked_together=16).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))
    kept = mixing.mixed_rows(docs, ranked_together=16)
    assert kept.columns == [*docs.columns, "mix"]
    assert kept.select("mix.taken").groupBy().sum().first()[0] == sum(taken.values())
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0


def test_knapsack_is_exact():
    random.seed(9)
    for _ in range(200):
        sizes = random.sample(range(1, 15), random.randint(1, 5))
        counts = [random.randint(1, 4) for _ in sizes]
        budget = random.randint(0, 40)
        sums = {0}
        for s, c in zip(sizes, counts):
            sums = {x + k * s for x in sums for k in range(c + 1)}
        taken = mixing.reachable(sizes, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        assert sum(s * t for s, t in zip(sizes, taken)) == max(x for x in sums if x <= budget)


@pytest.mark.parametrize("sizes, counts, budget, expected", [
    ([60_000, 50_000, 49_999], [1, 1, 1], 99_999, 99_999), ([60_000, 50_000, 30_000], [1, 1, 3], 140_000, 140_000),
    ([1_000_003, 999_983, 777_777], [2, 2, 2], 2_777_763, 2_777_763), ([100_000], [5], 250_000, 200_000), ([70_000, 40_000, 1], [1, 2, 7], 80_006, 80_006),
])
def test_few_long_documents_are_fitted_above_the_knapsack(sizes, counts, budget, expected):
    taken = mixing.fit_counts(np.array(sizes), np.array(counts), budget)
    assert all(0 <= t <= c for t, c in zip(taken, counts))
    assert int((taken * np.array(sizes)).sum()) == expected


def test_coarse_units_never_take_too_much():
    random.seed(12)
    for _ in range(60):
        sizes = np.array(sorted(random.sample(range(20_000, 400_000), random.randint(1, 9))))
        counts = np.array([random.randint(1, 4) for _ in sizes])
        budget = random.randint(0, int((sizes * counts).sum()))
        reached = [int((mixing.fit_counts(sizes, counts, budget, bits=bits) * sizes).sum()) for bits in (1 << 10, 1 << 16, 1 << 26)]
        assert max(reached) <= budget and reached[0] <= reached[2] + 400


def test_rows_without_an_id_are_told_apart_by_their_texts(spark):
    rows = [(None, f"w{i} " * 5, "s") for i in range(60)] + [(None, "same words here", "s")] * 3
    found = mixing.mix(documents(spark, rows), ranked_together=4)
    again = mixing.mix(documents(spark, rows, parts=5), ranked_together=4)
    assert values(found, "size", "taken") == values(again, "size", "taken")
    named = documents(spark, rows).withColumnRenamed("kept", "Mix")
    mixed = mixing.mixed_rows(named, ranked_together=4)
    assert [c for c in mixed.columns if c.lower() == "mix"] == ["mix"] and mixed.select("mix.taken").count() == mixed.count()

