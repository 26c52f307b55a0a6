"""Text columns: canonical country and comparable company name."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings, lower case, and the country each one stands for.
COUNTRY_SPELLINGS = {
    "usa": "United States",
    "us": "United States",
    "u.s.a": "United States",
    "united states": "United States",
    "uk": "United Kingdom",
    "u.k.": "United Kingdom",
    "britain": "United Kingdom",
    "united kingdom": "United Kingdom",
    "india": "India",
    "in": "India",
    "bharat": "India",
    "australia": "Australia",
    "aus": "Australia",
    "au": "Australia",
    "canada": "Canada",
    "ca": "Canada",
}


def stripped(raw: Column) -> Column:
    """Without white space of any kind (tabs, line ends, no-break spaces) around it."""
    return F.regexp_replace(raw, r"(?U)^\s+|\s+$", "")


def canonical_country(raw: Column) -> Column:
    """Canonical country, or NULL where the spelling is not known."""
    spellings = F.create_map(*[F.lit(v) for v in chain.from_iterable(COUNTRY_SPELLINGS.items())])
    return F.try_element_at(spellings, F.lower(stripped(raw)))


def comparable_name(raw: Column) -> Column:
    """Lower case without dots, hyphens and commas (so 'L.L.C.' reads 'llc') and with single spaces.

    A name with nothing left is NULL: nameless customers are not one company.
    """
    bare = F.translate(F.lower(raw), ".,-", "")
    spaced = F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))
    return F.nullif(spaced, F.lit(""))
