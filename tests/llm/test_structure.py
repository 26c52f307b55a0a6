"""Merkle manifests, conversation repair and toxicity, each against a plain Python version, round trips or held-out accuracy."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from recurra.llm import conversations, merkle, toxicity
from tests.llm.cases import documents, odd_documents, prose

LEAVES = "doc_id bigint, text string, lang string, source string, n_chars bigint, place string, digest string, grp string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(doc_id, text, lang, source, n_chars):
    return sha(*map(framed, (doc_id, source, lang, n_chars, text)))


# --- op 11

def levels(digests, fanout):
    found = [digests]
    while len(found[-1]) > 1:
        below = found[-1]
        found.append([sha(*below[i: i + fanout]) for i in range(0, len(below), fanout)])
    return found


def steps(tree, at, fanout):
    for level in tree[:-1]:
        first = at - at % fanout
        yield level[first:at], level[at + 1: first + fanout]
        at //= fanout


def plain_manifest(rows, fanout=2):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fanout) for g in langs}
    top = levels([trees[g][-1][0] for g in langs], fanout)
    found = []
    for number, lang in enumerate(langs):
        for at, (_, _, own, row) in enumerate(sorted(groups[lang], key=lambda x: x[:3])):
            path = [*steps(trees[lang], at, fanout), *steps(top, number, fanout)]
            folded = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None:
                folded = leaf(*row[:4], row[4] + 1)
            for left, right in path:
                folded = sha(*left, folded, *right)
            found.append((row[0], own, trees[lang][-1][0], top[-1][0], sha(*[d for left, right in path for d in left + right]), folded, folded == top[-1][0]))
    return sorted(found, key=repr)


def manifest(spark, rows, fanout=2, parts=3):
    table = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], LEAVES).repartition(parts)
    return sorted(map(tuple, merkle.manifest(table, fanout=fanout).collect()), key=repr)


def test_manifest(spark):
    odd = [None, "", " ", "é\U0001f600", "x" * 20_000, "a:b", "-"]
    rows = [(i, odd[i % len(odd)], [None, "", "de", "en", "é"][i % 5 if i < 40 else 3], "s" if i % 3 else None, i if i % 4 else None) for i in range(75)]
    rows += [(7, "again", "en", "s", 1), (7, "again", "en", "s", 1), (7, "other", "en", "s", 1), (None, "x", "en", None, None), (None, "x", None, None, 3), (-5, "", "fr", "", 0)]
    assert manifest(spark, rows) == plain_manifest(rows)
    assert manifest(spark, rows, parts=1) == manifest(spark, rows, parts=7)
    assert {r[-1] for r in plain_manifest(rows)} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 257])
def test_trees_of_any_size(spark, n):
    rows = [(i, f"t{i}", "en", "s", 1) for i in range(n)]
    assert manifest(spark, rows) == plain_manifest(rows)


def test_other_fanout_and_many_groups(spark):
    rows = [(i, "t", f"g{i % 37}", "s", 1) for i in range(100)]
    assert manifest(spark, rows, 3) == plain_manifest(rows, 3)


def test_manifest_of_nothing(spark):
    assert manifest(spark, []) == []


def test_text_stays_where_it_is_read(spark):
    plan = merkle.leaf_digest  # the digest is made of columns alone, in the scan
    rows = spark.createDataFrame([(1, "t", "en", "s", 1, "x", "x", "x")], LEAVES)
    found = rows.select(plan(rows.doc_id, rows.source, rows.lang, rows.n_chars, rows.text).alias("d"))
    assert found.first()["d"] == leaf(1, "t", "en", "s", 1)
    shown = merkle.manifest(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in shown and "CartesianProduct" not in shown and "NestedLoop" not in shown


# --- op 13

FAULTS = {"": conversations.FINE, "blank": conversations.BLANK, "duplicate": conversations.DUPLICATE, "truncated": conversations.CUT}


def fits(initials):
    rest = initials.removeprefix("s")
    return not initials or (rest and rest == "ua" * (len(rest) // 2))


def faults_of(rows):
    seen, found = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        found.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows):
    """All sequences of edits with at most a few insertions, tried one by one."""
    faults = faults_of(rows)
    best = None
    for inserted in itertools.product(range(3), repeat=len(rows) + 1):
        if sum(inserted) > 3:
            continue
        for edits in itertools.product("DKR", repeat=len(rows)):
            if any(e != "D" and f in ("blank", "duplicate") for e, f in zip(edits, faults)):
                continue
            cost = 2 * sum(inserted) + sum({"D": 3, "R": 2, "K": 0}[e] + (e != "D" and f == "truncated") for e, f in zip(edits, faults))
            audit = "".join("I" * n + e for n, e in zip(inserted, edits)) + "I" * inserted[-1]
            if best and (cost, audit) >= best[:2]:
                continue
            # What is made up may be either role: the grammar leaves one choice.
            made, roles = [], ""
            places = iter(zip(edits, rows))
            for edit in audit:
                role, text = next(r for e, r in places) if edit != "I" else (None, "")
                if edit == "D":
                    continue
                free = "assistant" if roles.endswith("u") else "user"
                role = role if edit == "K" else free
                made.append((role, text))
                roles += role[:1] or "?"
            if fits(roles):
                best = (cost, audit, made)
    return best


def solved(rows, block=conversations.BLOCK, monkeypatch=None):
    repair = conversations.Repair(1, keep_rows=True)
    for turn, ((role, text), fault) in enumerate(zip(rows, faults_of(rows))):
        repair.add(turn, role, text, FAULTS[fault])
    return repair.finish(), repair.decided


def test_lightest_repairs(monkeypatch):
    random.seed(3)
    for case in range(120):
        rows = [(random.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), random.choice(["A.", "B!", "cut", "", f"t{case}.", f"{random.random()}?"])) for _ in range(random.randint(0, 5))]
        cost, audit, made = cheapest(rows) if rows else (0, "", [])
        text = "\n".join(f"{r}:{t}" for r, t in made)
        for block in (1, 2, 256):
            monkeypatch.setattr(conversations, "BLOCK", block)
            result, decided = solved(rows)
            assert result[6:] == (cost, audit, sha(text)), rows
            assert [row[1:] for row in decided] == made


def test_blocks_agree_on_long_conversations(monkeypatch):
    random.seed(5)
    rows = [(random.choice(["user", "assistant", "assistant", "user", "system"]), random.choice([f"t{i}.", f"t{i}", "same.", ""])) for i in range(900)]
    found = set()
    for block in (7, 64, 1000):
        monkeypatch.setattr(conversations, "BLOCK", block)
        result, decided = solved(rows)
        found.add(result)
        assert sha("\n".join(f"{r}:{t}" for _, r, t in decided)) == result[-1]
        assert fits("".join(r[0] for _, r, _ in decided))
    assert len(found) == 1


TURNS = "conv_id bigint, turn bigint, role string, text string, fault string, dropped string"


def plain_damage(rows):
    for conv_id, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv_id, turn)).encode()) % 20
        if kind == 4:
            role = "user"
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(kind, text)
        yield from [(conv_id, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)


def plain_repairs(rows, damage):
    found = []
    left = list(plain_damage(rows)) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for conv_id in {r[0] for r in rows}:
        own = sorted((r[1:] for r in left if r[0] == conv_id), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in own if t is not None]
        pairs = [(role, text) for _, role, text in own]
        faults = faults_of(pairs)
        illegal = sum((a + b if a and b else "") not in ("su", "ua", "au") for a, b in itertools.pairwise(r[:1] for r, _ in pairs))
        cost, audit, made = cheapest(pairs) if pairs else (0, "", [])
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        found.append((conv_id, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in made))))
    return sorted(found, key=repr)


ODD_TURNS = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes!"), (1, 1, "assistant", "Yes!"), (1, 4, "user", " \t"), (2, None, None, None), (2, None, "user", None),
    (2, 3, "system", "é?"), (None, 0, "user", "No id."), (None, 0, "user", "No id."), (None, 1, "assistant", "x" * 50_000), (3, 5, "", "?"), (3, 2, "tool", "a"),
    (4, 1, "assistant", "Late."), (4, 0, "user", "ends  "), (5, 7, "user", "Same."), (5, 7, "assistant", "Same."), (5, -2, "user", "Same."), (6, 0, None, "a."),
]


@pytest.mark.parametrize("damage", [False, True])
def test_repairs_of_tables(spark, damage):
    rows = ODD_TURNS + [(c, t, ["user", "assistant"][t % 2], f"Turn {c % 3} {t}.") for c in range(10, 60) for t in range(c % 6)]
    table = spark.createDataFrame([(*r, "x", "x") for r in rows], TURNS).repartition(5)
    found = conversations.repair_conversations(table, damage=damage)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_repairs(rows, damage)
    lines = {}
    for r in sorted(conversations.repaired_rows(table, damage=damage).collect(), key=lambda r: r["place"]):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert {r["conv_id"]: r["repaired_sha256"] for r in found.collect()} == {c: sha("\n".join(lines.get(c, []))) for c in {r[0] for r in rows}}


def test_repairs_of_nothing(spark):
    table = spark.createDataFrame([], TURNS)
    assert conversations.repair_conversations(table, damage=True).count() == 0 and conversations.repaired_rows(table).count() == 0


def test_conversations_move_once(spark):
    table = spark.createDataFrame([(*r, "x", "x") for r in ODD_TURNS], TURNS)
    plan = conversations.repair_conversations(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


# --- op 12

def toxic_table(spark, n=420):
    """Every fourth document has a few words from a stock of its own; labels are wrong nowhere."""
    bad = [f"{a}{b}" for a in ("grumf", "snarl", "vexor") for b in ("", "ed", "ing", "ish")]
    random.seed(8)
    rows = []
    for i in range(n):
        words = prose(i, 120).split()
        if i % 4 == 0:
            for _ in range(8):
                words[random.randrange(len(words))] = random.choice(bad)
        rows.append((i, " ".join(words), "s"))
    return rows, spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(n)], "doc_id bigint, toxic int")


def test_toxicity_on_held_out_documents(spark):
    rows, labels = toxic_table(spark)
    found = {r["row"]["doc_id"]: r for r in toxicity.score_toxicity(documents(spark, rows), labels, keep=["doc_id"]).collect()}
    held = [i for i in found if zlib.crc32(str(i).encode()) % 3 == 1]
    assert [i for i in found if found[i]["held_out"]] == [i for i in found if i in set(held)]
    right = sum(found[i]["predicted"] == (i % 4 == 0) for i in held)
    assert right >= 0.95 * len(held)
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in found.values())


def test_scores_depend_on_the_text_alone(spark):
    rows, labels = toxic_table(spark, 240)
    odd, odd_rows = odd_documents(spark)
    moved = [(10_000 + i, t, "other") for i, (_, t, *_) in enumerate(rows)] + [(None, rows[0][1], None), (20_000, rows[0][1] + "\n" + "z" * 100_000, "s")]
    docs = documents(spark, rows + moved).union(odd)
    unlabelled = labels.union(spark.createDataFrame([(None, 1), (3, None), (99_999, 1)], labels.schema))
    found = toxicity.score_toxicity(docs, unlabelled)
    assert found.count() == len(rows) + len(moved) + len(odd_rows)
    by_text = {}
    for r in found.select("row.text", "score").collect():
        by_text.setdefault(r["text"] or "", set()).add(r["score"])
    assert all(len(scores) == 1 for scores in by_text.values())


def test_toxicity_without_anything_to_learn(spark):
    docs, rows = odd_documents(spark)
    labels = spark.createDataFrame([(i, 0) for i in range(20)], "doc_id bigint, toxic int")
    assert {(r["score"], r["predicted"]) for r in toxicity.score_toxicity(docs, labels).collect()} == {(0.5, 0)}
    assert toxicity.score_toxicity(docs, labels.limit(0)).count() == len(rows)
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_windows_cover_whole_texts():
    text = (" ".join(f"W{i}" for i in range(100_000)) + " " + "y" * 5_000).encode()
    assert b"".join(toxicity.windows(text)).replace(b" ", b"") == text.lower().replace(b" ", b"")
    assert max(map(len, toxicity.windows(text))) <= toxicity.WINDOW_BYTES and list(toxicity.windows(b" \n")) == []


def test_threshold_and_weights():
    assert toxicity.best_threshold(np.array([0.0, 1, 2, 3]), np.array([False, False, True, True])) == 1.5
    # One clean value among toxic ones costs more than the toxic ones below it.
    assert toxicity.best_threshold(np.array([0.0, 1, 2, 3]), np.array([True, False, True, True]), clean_weight=4) == 1.5
    weights = toxicity.fit_logistic(np.array([[0.0], [0.1], [1.0], [1.1]]), np.array([False, False, True, True]))
    assert weights[0] > 0 > weights[1]
