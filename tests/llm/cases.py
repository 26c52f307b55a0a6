"""Small documents with everything that may go wrong, and ways to read results."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("source", StringType()), StructField("n_chars", LongType()),
    # Names that operators use for columns of their own.
    *[StructField(name, StringType()) for name in ("row", "words", "key", "found", "line", "hash", "size", "turn", "of", "id", "kept", "a.b")],
])

WORDS = "the cat sat on a mat while seven grey mice ran over it and nobody in that old house said a thing about".split()


def document(doc_id, text, source="s"):
    return (doc_id, text, source, len(text or ""), *["x"] * (len(DOCS) - 4))


def documents(spark, rows, parts=2):
    return spark.createDataFrame([document(*r) for r in rows], DOCS).repartition(parts)


def prose(seed, n=80):
    """Different words for every seed and place, so that no two texts share a phrase by chance."""
    return " ".join(f"{WORDS[(seed * 7 + i * i) % len(WORDS)]}{(seed * 31 + i) % 97}" for i in range(n))


ODD_TEXTS = [
    None, "", "   \n\t ", "one", "a b", "\n\n\n", "é ß    x", "<|endoftext|> 's 'll", "same same same same same same",
    "UNDER THE MIT LICENSE", "tab\tand\x0bvertical\x0cfeed\rreturn", "0 1 2 3 4 5 6 7 8 9 10", "\U0001f600 " * 5, "x" * 5000, "w " * 3000,
]


def odd_documents(spark):
    """Every odd text twice, some rows repeated whole, some without an id or a source."""
    rows = [(i, t, "s" if i % 3 else None) for i, t in enumerate(ODD_TEXTS + ODD_TEXTS)]
    rows += [rows[3], rows[3], (None, "one", "s"), (None, None, None), (None, prose(1), "t")]
    return documents(spark, rows), rows


def by_id(df, column="doc_id"):
    return {r[column]: r for r in df.collect()}


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
