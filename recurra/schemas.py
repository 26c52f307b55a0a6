"""Raw (messy, mostly text) and clean (typed) table schemas, keys, references and value domains."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
PRICE = T.DecimalType(10, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


_TEXT, _LONG, _INT, _DATE, _BOOL = T.StringType(), T.LongType(), T.IntegerType(), T.DateType(), T.BooleanType()

RAW = {
    "customers": _struct(
        customer_id=_LONG, company_name=_TEXT, country=_TEXT, company_size_band=_TEXT, signup_date=_TEXT,
        acquisition_channel=_TEXT,
    ),
    "plans": _struct(plan_id=_INT, plan_name=_TEXT, tier=_TEXT, monthly_price=_TEXT, annual_price=_TEXT),
    "subscriptions": _struct(
        subscription_id=_LONG, customer_id=_LONG, plan_id=_INT, start_date=_TEXT, end_date=_TEXT,
        billing_cycle=_TEXT, status=_TEXT,
    ),
    "invoices": _struct(
        invoice_id=_LONG, subscription_id=_LONG, invoice_date=_TEXT, amount=_TEXT, payment_status=_TEXT,
    ),
    "usage_monthly": _struct(customer_id=_LONG, month=_TEXT, login_count=_INT, feature_usage_count=_INT),
    "support_tickets": _struct(
        ticket_id=_LONG, customer_id=_LONG, created_date=_TEXT, resolved_date=_TEXT, priority=_TEXT, category=_TEXT,
    ),
}

CLEAN = {
    "customers": _struct(
        customer_id=_LONG, company_name=_TEXT, country=_TEXT, company_size_band=_TEXT, signup_date=_DATE,
        acquisition_channel=_TEXT, signup_date_ambiguous=_BOOL,
    ),
    "plans": _struct(plan_id=_INT, plan_name=_TEXT, tier=_TEXT, monthly_price=PRICE, annual_price=PRICE),
    "subscriptions": _struct(
        subscription_id=_LONG, customer_id=_LONG, plan_id=_INT, start_date=_DATE, end_date=_DATE,
        billing_cycle=_TEXT, status=_TEXT,
    ),
    "invoices": _struct(
        invoice_id=_LONG, subscription_id=_LONG, invoice_date=_DATE, amount=MONEY, payment_status=_TEXT,
        is_outlier=_BOOL,
    ),
    "usage_monthly": _struct(customer_id=_LONG, usage_month=_DATE, login_count=_LONG, feature_usage_count=_LONG),
    "support_tickets": _struct(
        ticket_id=_LONG, customer_id=_LONG, created_date=_DATE, resolved_date=_DATE, priority=_TEXT, category=_TEXT,
    ),
}

TABLES = tuple(CLEAN)

# True where a reader could not make sense of a row, or of a value in it.
MALFORMED = "_malformed"

PRIMARY_KEYS = {
    "customers": ("customer_id",),
    "plans": ("plan_id",),
    "subscriptions": ("subscription_id",),
    "invoices": ("invoice_id",),
    "usage_monthly": ("customer_id", "usage_month"),
    "support_tickets": ("ticket_id",),
}

# (child table, column, parent table, parent column)
FOREIGN_KEYS = (
    ("subscriptions", "customer_id", "customers", "customer_id"),
    ("subscriptions", "plan_id", "plans", "plan_id"),
    ("invoices", "subscription_id", "subscriptions", "subscription_id"),
    ("usage_monthly", "customer_id", "customers", "customer_id"),
    ("support_tickets", "customer_id", "customers", "customer_id"),
)

REQUIRED = {
    "customers": ("company_name", "country", "signup_date"),
    "plans": ("plan_name", "tier", "monthly_price", "annual_price"),
    "subscriptions": ("customer_id", "plan_id", "start_date", "billing_cycle", "status"),
    "invoices": ("subscription_id", "invoice_date", "amount", "payment_status"),
    "usage_monthly": ("customer_id", "usage_month", "login_count", "feature_usage_count"),
    "support_tickets": ("customer_id", "created_date", "priority", "category"),
}

# The allowed values of the coded columns.
DOMAINS = {
    "subscriptions": {"billing_cycle": ("monthly", "annual"), "status": ("active", "cancelled")},
    "invoices": {"payment_status": ("paid", "failed", "refunded")},
    "support_tickets": {"priority": ("Low", "Medium", "High", "Urgent")},
}
