"""What the operators share: the definition of words, and how long texts are taken in pieces."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two kinds of words, as regular expressions over characters.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
PLAIN_WORD_LOWER = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# ASCII white space, which is also what bytes.split() takes as white space.
BLANKS = " \t\n\x0b\x0c\r"
_BLANK = re.compile(rb"[ \t-\r]")

# Every byte that is no part of a plain word becomes a blank, A-Z become a-z, bytes of other characters stay.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

PIECE_BYTES = 1 << 20


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table. Also lets Python workers import this package from where the driver has it, whatever folder they start in."""
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The blank-separated words of a text, about `size` bytes at a time, so that a huge text is never all objects at once."""
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            blank = _BLANK.search(data, end)
            end = blank.start() if blank else len(data)
        yield data[at:end].split()
        at = end


def spaced_words(text: Column) -> Column:
    """Array of blank-separated words; empty for null and for blank texts."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t-\r]+"))


def count_spaced_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("bigint")


def all_columns(df: DataFrame) -> list[Column]:
    """Every column, whatever characters its name has."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` without some columns; unlike drop, whatever characters the names of the others have."""
    return df.select(*[c for c, name in zip(all_columns(df), df.columns) if name not in names])


def packed(df: DataFrame) -> Column:
    """A whole row as one column `row`, so that no name of its columns can clash with a working column."""
    return F.struct(*all_columns(df)).alias("row")


def map_batches(
    df: DataFrame, of_batches: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """mapInArrow for rows that carry a user's columns: those go by number, whatever their names."""
    names = [f"c{n}" for n in range(len(schema))]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in of_batches(batches):
            yield batch.rename_columns(names)

    kinds = T.StructType([T.StructField(name, field.dataType) for name, field in zip(names, schema.fields)])
    return df.toDF(*[f"c{n}" for n in range(len(df.columns))]).mapInArrow(numbered, kinds).toDF(*schema.names)


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with a column that no later step computes anew. Spark moves projections into what uses them, which inside a function
    over array elements means once for each element; it does not move what a generator made."""
    return df.select(*all_columns(df), F.explode(F.array(value)).alias(name))
