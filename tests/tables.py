"""Short ways to write small tables."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from recurra.schemas import CLEAN, RAW

SNAPSHOT = date(2025, 12, 31)
STARTER, PROFESSIONAL, ENTERPRISE = 1, 2, 3


def day(text):
    return date.fromisoformat(text) if text else None


def plans(spark):
    rows = [
        (STARTER, "Starter", "Starter", Decimal(29), Decimal(290)),
        (PROFESSIONAL, "Professional", "Professional", Decimal(79), Decimal(790)),
        (ENTERPRISE, "Enterprise", "Enterprise", Decimal(199), Decimal(1990)),
    ]
    return spark.createDataFrame(rows, CLEAN["plans"])


def subscriptions(spark, *rows):
    """Rows of (customer, plan, start, end[, cycle]); an end makes the subscription cancelled."""
    full = [
        (i, c, p, day(start), day(end), rest[0] if rest else "monthly", "cancelled" if end else "active")
        for i, (c, p, start, end, *rest) in enumerate(rows, 1)
    ]
    return spark.createDataFrame(full, CLEAN["subscriptions"])


def customers(spark, *rows):
    """Rows of (customer, signup[, channel[, country]])."""
    full = [
        (c, f"Company {c}", (rest[1:] or ["India"])[0], "1-10", day(signup), (rest[:1] or ["Direct"])[0], False)
        for c, signup, *rest in rows
    ]
    return spark.createDataFrame(full, CLEAN["customers"])


def invoices(spark, *rows):
    """Rows of (subscription, amount[, status])."""
    full = [
        (i, s, date(2025, 1, 1), Decimal(amount), (rest or ["paid"])[0], False)
        for i, (s, amount, *rest) in enumerate(rows, 1)
    ]
    return spark.createDataFrame(full, CLEAN["invoices"])


def usage(spark, *rows):
    """Rows of (customer, month, logins)."""
    return spark.createDataFrame([(c, day(m), n, n) for c, m, n in rows], CLEAN["usage_monthly"])


def raw(spark, table, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], RAW[table])


def rows(df):
    return [tuple(r) for r in df.collect()]


def by(df, *keys):
    """Rows as dicts, by the values of the key columns."""
    found = {}
    for r in df.collect():
        key = tuple(r[k] for k in keys)
        found[key[0] if len(keys) == 1 else key] = r.asDict()
    return found
