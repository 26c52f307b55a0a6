"""Date columns: messy text to date, and month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recurra.functions.text import stripped

# The accepted date formats.
ISO = r"^\d{4}-\d{1,2}-\d{1,2}$"
YEAR_MONTH = r"^\d{4}-\d{1,2}$"
NAMED_MONTH = r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"
SLASHED = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"


def iso_date(raw: Column) -> Column:
    """ISO text to date; blank or unreadable text becomes NULL."""
    text = stripped(raw)
    return F.when(text.rlike(ISO), text.try_cast("date"))


def first_of_month(raw: Column) -> Column:
    """'2023-09' to the first day of that month."""
    text = stripped(raw)
    return F.when(text.rlike(YEAR_MONTH), F.concat(text, F.lit("-01")).try_cast("date"))


def _rearranged(text: Column, order: str) -> Column:
    # Rewritten to ISO and cast: an impossible date is a plain NULL, where a failing pattern parse
    # would raise and catch inside the JVM for row after row.
    return F.regexp_replace(text, SLASHED, order).try_cast("date")


def _day_first(text: Column) -> Column:
    return _rearranged(text, "$3-$2-$1")


def _month_first(text: Column) -> Column:
    return _rearranged(text, "$3-$1-$2")


def messy_date(raw: Column) -> Column:
    """ISO, or day-month name-year, or slashes: day first if that is a date, else month first."""
    text = stripped(raw)
    return (
        F.when(text.rlike(ISO), text.try_cast("date"))
        .when(text.rlike(NAMED_MONTH), F.try_to_date(text, "d-MMM-yyyy"))
        .when(text.rlike(SLASHED), F.coalesce(_day_first(text), _month_first(text)))
    )


def is_ambiguous_date(raw: Column) -> Column:
    """True where a slash date reads as a valid date both ways round, equal parts included."""
    text = stripped(raw)
    both = _day_first(text).isNotNull() & _month_first(text).isNotNull()
    return F.when(text.rlike(SLASHED), both).otherwise(False)


def month_of(date: Column) -> Column:
    return F.trunc(date, "MM")


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole calendar months between the months of two dates."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))
