"""Small hand-written cases, one per place where a plausible reading gives another number."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from tables import (
    ENTERPRISE, PROFESSIONAL, SNAPSHOT, STARTER, by, customers, invoices, plans, raw, rows, subscriptions, usage,
)

from recurra.operators import churn, cleaning, cohort, mrr, report, spine, usage as usage_ops, value
from recurra.operators.invoices import invoice_price_check

DECEMBER = date(2025, 12, 1)


def priced(spark, *subs):
    return mrr.subscription_mrr(subscriptions(spark, *subs), plans(spark))


def test_the_two_conventions_of_active_differ(spark):
    subs = subscriptions(spark, (1, STARTER, "2025-12-29", None))
    assert rows(spine.active_month_start(subs, snapshot=SNAPSHOT)) == []
    assert rows(spine.active_overlap(subs, snapshot=SNAPSHOT)) == [(1, 1, DECEMBER)]


def test_the_previous_month_is_the_previous_active_month(spark):
    fact = mrr.fact_mrr_waterfall(
        priced(spark, (1, STARTER, "2025-01-01", "2025-02-15"), (1, PROFESSIONAL, "2025-05-01", None)),
        snapshot=SNAPSHOT,
    )
    found = by(fact, "month")
    assert found[date(2025, 5, 1)]["movement_type"] == "expansion"
    assert found[date(2025, 5, 1)]["mrr_delta"] == Decimal(50)
    assert [r["movement_type"] for r in found.values()].count("new") == 1


def test_equal_amounts_of_a_customer_count_once_in_churned_revenue(spark):
    subs = priced(spark, (1, STARTER, "2025-01-01", "2025-02-20"), (1, STARTER, "2025-01-01", "2025-02-20"))
    february = date(2025, 2, 1)
    assert by(mrr.customer_month_mrr(subs, snapshot=SNAPSHOT), "month")[february]["mrr"] == Decimal(58)
    gone = by(churn.fact_churn_by_month(subs, snapshot=SNAPSHOT), "month")[february]
    assert (gone["churned_mrr"], gone["customers_churned"]) == (Decimal(29), 1)


def test_nobody_is_measured_past_the_snapshot(spark):
    subs = priced(spark, (1, STARTER, "2025-01-01", None))
    assert DECEMBER not in by(churn.fact_churn_by_month(subs, snapshot=SNAPSHOT), "month")
    assert DECEMBER in by(churn.monthly_churn(subs, snapshot=SNAPSHOT), "month")
    matrix = cohort.cohort_retention_matrix(customers(spark, (1, "2025-01-05")), subs, snapshot=SNAPSHOT)
    cells = by(matrix, "cohort_month")[date(2025, 1, 1)]
    assert (cells["m11"], cells["m12"]) == (Decimal("100.0"), None)


def test_a_measurable_empty_cell_is_zero(spark):
    subs = subscriptions(spark, (1, STARTER, "2024-01-01", "2024-02-10"))
    matrix = cohort.cohort_retention_matrix(customers(spark, (1, "2024-01-05")), subs, snapshot=SNAPSHOT)
    cells = by(matrix, "cohort_month")[date(2024, 1, 1)]
    assert (cells["m1"], cells["m2"], cells["m12"]) == (Decimal(100), Decimal(0), Decimal(0))
    summary = cohort.cohort_m12_summary(customers(spark, (1, "2024-01-05")), subs, snapshot=SNAPSHOT)
    assert rows(summary) == [(Decimal(0), Decimal(0), Decimal(0), 1)]


def test_a_cancelled_subscription_is_not_a_lost_customer(spark):
    subs = priced(spark, (1, STARTER, "2025-01-01", "2025-03-10"), (1, PROFESSIONAL, "2025-01-01", None))
    march = date(2025, 3, 1)
    assert by(churn.monthly_churn(subs, snapshot=SNAPSHOT), "month")[march]["customers_churned"] == 1
    assert by(churn.fact_churn_by_month(subs, snapshot=SNAPSHOT), "month")[march]["customers_churned"] == 0


@pytest.mark.parametrize("end, overlap", [("2025-01-05", []), ("2025-03-05", [date(2025, 3, 1)])])
def test_an_end_before_the_start(spark, end, overlap):
    subs = subscriptions(spark, (1, STARTER, "2025-03-10", end))
    assert rows(spine.active_month_start(subs, snapshot=SNAPSHOT)) == []
    assert [m for _, _, m in rows(spine.active_overlap(subs, snapshot=SNAPSHOT))] == overlap


def test_messy_dates(spark):
    cases = {
        "03/04/2023": (date(2023, 4, 3), True),
        "05/05/2023": (date(2023, 5, 5), True),
        "13/04/2023": (date(2023, 4, 13), False),
        "04/13/2023": (date(2023, 4, 13), False),
        "31/04/2023": (None, False),
        "13/13/2023": (None, False),
        "30/02/2023": (None, False),
        "0/5/2023": (None, False),
        "2023-9-5": (date(2023, 9, 5), False),
        " 2023-09-05 ": (date(2023, 9, 5), False),
        "2023-02-30": (None, False),
        "13-sep-2023": (date(2023, 9, 13), False),
        "3-Sep-2023": (date(2023, 9, 3), False),
        "31-Feb-2023": (None, False),
        "3-Foo-2023": (None, False),
        "x": (None, False),
        "": (None, False),
        None: (None, False),
    }
    table = raw(spark, "customers", *[(i, "n", "US", None, text, None) for i, text in enumerate(cases)])
    parsed = by(cleaning.parse_messy_date(table), "customer_id")
    assert [(r["signup_date"], r["signup_date_ambiguous"]) for _, r in sorted(parsed.items())] == list(cases.values())


def test_outliers_are_judged_by_list_price_with_strict_bounds(spark):
    subs = subscriptions(spark, (1, STARTER, "2025-01-01", None), (1, STARTER, "2025-01-01", None, "annual"))
    amounts = [(1, a) for a in ("29.00", "145.00", "145.01", "5.80", "5.79")] + [(2, "290.00"), (99, "1.00")]
    flagged = cleaning.flag_invoice_outliers(invoices(spark, *amounts), subs, plans(spark))
    assert sorted(r["amount"] for r in flagged.collect() if r["is_outlier"]) == [Decimal("5.79"), Decimal("145.01")]
    assert by(flagged, "subscription_id")[99]["expected_price"] is None


def test_annual_invoices_have_two_expected_prices(spark):
    subs = subscriptions(spark, (1, STARTER, "2025-01-01", None, "annual"))
    bill = invoices(spark, (1, "290.00"))
    flagged = rows(cleaning.flag_invoice_outliers(bill, subs, plans(spark)))
    assert flagged == [(1, 1, Decimal(290), Decimal(290), False)]
    assert rows(invoice_price_check(bill, subs, plans(spark)))[0][1] == 290 / 12


def test_a_missing_and_an_unknown_channel_stay_apart(spark):
    who = customers(spark, (1, "2025-01-01", None), (2, "2025-01-01", "Unknown"))
    subs = subscriptions(spark, (1, STARTER, "2025-01-01", None), (2, STARTER, "2025-01-01", None))
    table = value.clv_by_segment(
        who, subs, invoices(spark, (1, "29"), (2, "79")), plans(spark), snapshot=SNAPSHOT, segment="acquisition_channel"
    )
    assert [r[0] for r in rows(table)] == ["Unknown", "Unknown"]


def test_percentages_round_half_up(spark):
    who = customers(spark, *[(c, "2025-01-01") for c in range(16)])
    subs = subscriptions(spark, (1, STARTER, "2025-01-01", None))
    kept = cohort.cohort_retention(who, subs, snapshot=SNAPSHOT)
    assert by(kept, "months_since_signup")[0]["retention_pct"] == Decimal("6.3")


def test_average_tenure_is_the_average_of_rounded_tenures(spark):
    start = SNAPSHOT - timedelta(days=14), SNAPSHOT - timedelta(days=17)
    subs = subscriptions(spark, (1, STARTER, start[0].isoformat(), None), (2, STARTER, start[1].isoformat(), None))
    who, bills = customers(spark, (1, "2025-01-01"), (2, "2025-01-01")), invoices(spark, (1, "29"), (2, "29"))
    clv = by(value.fact_customer_clv(who, subs, bills, snapshot=SNAPSHOT), "customer_id")
    assert [clv[c]["tenure_months"] for c in (1, 2)] == [Decimal("0.5"), Decimal("0.6")]
    segment = value.clv_by_segment(who, subs, bills, plans(spark), snapshot=SNAPSHOT, segment="country")
    assert rows(segment)[0][3] == Decimal("0.6")


def test_top_rows_break_ties_by_customer(spark):
    ids = range(25)
    used = [(c, f"2025-{m:02d}-01", 10 if m < 3 else 1) for c in ids for m in (1, 2, 3)]
    subs = subscriptions(spark, *[(c, STARTER, "2025-01-01", None) for c in ids])
    risk = usage_ops.revenue_at_risk(
        usage(spark, *used), customers(spark, *[(c, "2025-01-01") for c in ids]),
        mrr.subscription_mrr(subs, plans(spark)),
    )
    assert [r[0] for r in rows(risk)] == list(range(20))


def test_trailing_usage_counts_rows_not_months(spark):
    months = ["2025-01", "2025-02", "2025-03", "2025-05", "2025-06", "2025-07", "2025-08"]
    used = usage(spark, *[(1, f"{m}-01", 4 if m == "2025-08" else 10) for m in months])
    trailing = by(usage_ops.trailing_usage(used), "usage_month")
    assert trailing[date(2025, 1, 1)]["trailing_avg_logins"] is None
    assert trailing[date(2025, 8, 1)]["trailing_avg_logins"] == 10.0
    subs = subscriptions(spark, (1, STARTER, "2025-01-01", None))
    risk = usage_ops.revenue_at_risk(used, customers(spark, (1, "2025-01-01")), mrr.subscription_mrr(subs, plans(spark)))
    assert rows(risk) == [(1, "Company 1", 4, Decimal("10.0"), Decimal("-60.0"), Decimal(29))]


def test_a_first_usage_row_is_never_at_risk(spark):
    subs = subscriptions(spark, (1, STARTER, "2025-01-01", None))
    risk = usage_ops.revenue_at_risk(
        usage(spark, (1, "2025-01-01", 0)), customers(spark, (1, "2025-01-01")),
        mrr.subscription_mrr(subs, plans(spark)),
    )
    assert rows(risk) == []


def test_revenue_now_counts_any_active_subscription_of_the_base(spark):
    subs = priced(spark, (1, STARTER, "2024-01-01", "2025-06-01"), (1, PROFESSIONAL, "2025-09-01", None))
    assert rows(mrr.net_revenue_retention(subs, snapshot=SNAPSHOT)) == [(Decimal(29), Decimal(79), Decimal("272.4"))]


def test_retention_without_a_base_has_no_percentage(spark):
    subs = priced(spark, (1, STARTER, "2025-09-01", None))
    assert rows(mrr.net_revenue_retention(subs, snapshot=SNAPSHOT))[0][2] is None


def test_the_calendar_can_run_past_the_snapshot(spark):
    subs = subscriptions(spark, (1, STARTER, "2025-11-01", "2026-02-10"), (2, STARTER, "2025-11-15", None))
    last_end = spine.month_spine(subs, snapshot=SNAPSHOT, horizon=spine.TO_LAST_END)
    to_snapshot = spine.month_spine(subs, snapshot=SNAPSHOT, horizon=spine.TO_SNAPSHOT)
    assert max(rows(last_end)) == (date(2026, 2, 1),)
    assert max(rows(to_snapshot)) == (DECEMBER,)
    months = {(c, m) for _, c, m in rows(spine.active_month_start(subs, snapshot=SNAPSHOT))}
    assert (2, date(2026, 2, 1)) in months and (1, date(2026, 2, 1)) in months


def test_months_before_signup_are_outside(spark):
    subs = subscriptions(spark, (1, STARTER, "2025-02-01", "2025-03-20"))
    kept = cohort.fact_cohort_retention(customers(spark, (1, "2025-03-01")), subs, snapshot=SNAPSHOT)
    assert [r["months_since_signup"] for r in kept.collect()] == [0]


def test_a_customer_with_two_tiers_counts_twice_beside_a_distinct_count(spark):
    subs = subscriptions(spark, (1, STARTER, "2025-12-01", None), (1, ENTERPRISE, "2025-12-01", None))
    who = customers(spark, (1, "2025-12-01", None))
    summary = report.monthly_summary(subs, plans(spark), who, snapshot=SNAPSHOT)
    found = by(summary, "month")[DECEMBER]
    assert (found["active_customers"], found["active_customers_distinct"]) == (2, 1)
    assert found["mom_growth_pct"] is None
    cells = rows(mrr.pivot_source(subs, plans(spark), who, snapshot=SNAPSHOT))
    assert {(tier, channel) for _, tier, channel, *_ in cells} == {("Starter", "Unknown"), ("Enterprise", "Unknown")}


def test_the_summary_has_a_row_for_every_month(spark):
    subs = subscriptions(spark, (1, STARTER, "2025-01-01", "2025-01-20"), (1, STARTER, "2025-04-01", None))
    summary = by(report.monthly_summary(subs, plans(spark), customers(spark, (1, "2025-01-01")), snapshot=SNAPSHOT), "month")
    assert len(summary) == 12
    gap = summary[date(2025, 2, 1)]
    assert (gap["total_mrr"], gap["active_customers"], gap["logo_churn_rate"], gap["mom_growth_pct"]) == (0, 0, 0.0, -1.0)
    assert summary[date(2025, 3, 1)]["mom_growth_pct"] is None
    review = report.business_review(
        report.monthly_summary(subs, plans(spark), customers(spark, (1, "2025-01-01")), snapshot=SNAPSHOT),
        month=date(2025, 1, 1),
    )
    assert rows(review)[0][-2:] == ("red", None)


def test_amounts(spark):
    table = raw(spark, "invoices", *[(i, 1, "2025-01-01", a, "paid") for i, a in enumerate(["29", "$1,234.00", "abc", None])])
    cleaned = [r for _, r in sorted(by(cleaning.clean_amount(table), "invoice_id").items())]
    assert [r["amount"] for r in cleaned] == [Decimal(29), Decimal(1234), None, None]
    assert [r["was_formatted"] for r in cleaned] == [False, True, False, False]


def test_nameless_customers_are_not_one_company(spark):
    names = {1: None, 2: None, 3: "Acme, L.L.C.", 4: " acme  llc ", 5: "", 6: " . "}
    table = raw(spark, "customers", *[(i, n, "US", None, "2025-01-01", None) for i, n in names.items()])
    assert rows(cleaning.customer_remap(table)) == [(4, 3)]


def test_annual_prices_are_a_twelfth_to_the_cent(spark):
    subs = priced(spark, *[(1, p, "2025-01-01", None, "annual") for p in (STARTER, PROFESSIONAL, ENTERPRISE)])
    assert [by(subs, "plan_id")[p]["mrr"] for p in (1, 2, 3)] == [Decimal("24.17"), Decimal("65.83"), Decimal("165.83")]


def test_an_unknown_billing_cycle_has_no_revenue(spark):
    assert rows(priced(spark, (1, STARTER, "2025-01-01", None, "weekly")))[0][-1] is None
