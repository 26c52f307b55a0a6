"""Token counts of a byte-level BPE vocabulary, by rank-synchronous merging of arrays.

Texts are cut into pre-tokens; the distinct ones of a batch are held as one ragged array of symbols. In every round each sequence
finds its lowest-ranked pair and merges all places of it at once, leftmost first where places overlap; sequences without a pair
are done and leave the array. What is left of a sequence is its number of tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1024
# Texts are counted together up to so many characters; a longer text is cut up as it goes.
BATCH_CHARS = 1 << 20
PIECES_AT_ONCE = 200_000
# What a task remembers of pre-tokens it has counted, in characters.
KNOWN_CHARS = 16 << 20

# Fixed value: how the vocabulary's pre-tokenizer cuts texts.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRE_TOKEN = regex.compile(PRE_TOKEN)
NO_RANK = np.iinfo(np.int64).max


def byte_names() -> dict[int, str]:
    """How vocabulary files write bytes: printable ones as themselves, the others as the characters from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Pairs in order of (left, right), each with its rank and the symbol it becomes; the symbol of every byte; whole special strings."""

    width: int
    bytes: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    special: list[str]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        ids = whole["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in whole["model"]["merges"]]
        width = max(ids.values()) + 1
        pairs = np.array([ids[a] * width + ids[b] for a, b in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        return cls(
            width, np.array([ids[name] for _, name in sorted(byte_names().items())], np.int64), pairs[order], order,
            np.array([ids[a + b] for a, b in merges], np.int64)[order], [t["content"] for t in whole["added_tokens"]],
        )

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Numbers in `pairs`, -1 for what is no pair."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, at, -1)


def merged_lengths(pieces: list[bytes], vocabulary: Vocabulary) -> np.ndarray:
    """How many symbols are left of each piece."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    out = lengths.copy()
    symbols = vocabulary.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), lengths)
    while len(symbols) > 1:
        pair = np.full(len(symbols), -1)
        inside = owner[1:] == owner[:-1]
        pair[:-1][inside] = vocabulary.look_up(symbols[:-1][inside], symbols[1:][inside])
        rank = np.where(pair >= 0, vocabulary.ranks[pair], NO_RANK)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        lowest = np.minimum.reduceat(rank, starts)
        sizes = np.diff(starts, append=len(owner))
        out[owner[starts]] = sizes
        lowest = np.repeat(lowest, sizes)
        hit = (rank == lowest) & (lowest < NO_RANK)
        if not hit.any():
            break
        # In a run of places that overlap (a a a ...) every other one is merged, from the left.
        places = np.flatnonzero(hit)
        run = np.flatnonzero(np.diff(places, prepend=-2) != 1)
        offset = np.arange(len(places)) - np.repeat(run, np.diff(run, append=len(places)))
        places = places[offset % 2 == 0]
        symbols[places] = vocabulary.merged[pair[places]]
        left = lowest < NO_RANK
        left[places + 1] = False
        symbols, owner = symbols[left], owner[left]
        if len(symbols):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            out[owner[starts]] = np.diff(starts, append=len(owner))
    return out


class Counter:
    """Counts texts; remembers pre-tokens up to a bound."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.known: dict[str, int] = {}
        self.known_chars = 0
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.special))) if vocabulary.special else None

    def _learn(self, pieces: set[str]) -> None:
        fresh = list(pieces.difference(self.known))
        if not fresh:
            return
        chars = sum(map(len, fresh))
        if self.known_chars + chars > KNOWN_CHARS:
            self.known, self.known_chars = {}, 0
            fresh = list(pieces)
            chars = sum(map(len, fresh))
        self.known.update(zip(fresh, merged_lengths([p.encode() for p in fresh], self.vocabulary).tolist()))
        self.known_chars += chars

    def _parts(self, text: str) -> tuple[list[str], int]:
        """What lies between special strings, and how many of those there are; each is one token."""
        if self.special is None or not self.special.search(text):
            return [text], 0
        parts = self.special.split(text)
        return parts, len(parts) - 1

    def _count_long(self, part: str) -> int:
        total, found = 0, (m.group() for m in _PRE_TOKEN.finditer(part))
        while pieces := list(islice(found, PIECES_AT_ONCE)):
            self._learn(set(pieces))
            total += sum(map(self.known.__getitem__, pieces))
        return total

    def count(self, texts: list[str]) -> list[int]:
        cut: list[tuple[list[str], int]] = []
        for text in texts:
            parts, extra = self._parts(text)
            pieces: list[str] = []
            for part in parts:
                if len(part) > BATCH_CHARS:
                    extra += self._count_long(part)
                else:
                    pieces += _PRE_TOKEN.findall(part)
            cut.append((pieces, extra))
        self._learn(set().union(*(pieces for pieces, _ in cut)))
        return [sum(map(self.known.__getitem__, pieces)) + extra for pieces, extra in cut]


def count_tokens(
    docs: DataFrame, vocabulary_path: str, *, id_column: str = "doc_id", text_column: str = "text", limit: int = LIMIT
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row.

    Tokens are those of the vocabulary file at `vocabulary_path` (read by the driver and sent to the tasks), without any that
    stand for beginning or end; the file's special strings are one token each where a text has them. Null and empty texts have
    no bytes and no tokens. Repeated rows are counted each time; other columns are not read. No rows: no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary_path))  # about a megabyte for 50,000 pairs

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sent.value)
        for batch in batches:
            counts, waiting, chars = [], [], 0
            for value in batch.column(1):
                waiting.append(value.as_py() or "")
                chars += len(waiting[-1])
                if chars >= BATCH_CHARS:
                    counts += counter.count(waiting)
                    waiting, chars = [], 0
            counts += counter.count(waiting)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    text = F.col(text_column)
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"))
    counted = rows.mapInArrow(of_batches, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
