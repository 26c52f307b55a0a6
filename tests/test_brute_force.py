"""Operators against plain Python over random subscriptions, one customer holding a third of them."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from tables import by, customers, invoices, plans, rows, subscriptions

from recurra.operators import churn, cohort, mrr, quality, report, value

SNAPSHOT = date(2024, 12, 31)
PRICE = {1: Decimal("29"), 2: Decimal("79"), 3: Decimal("199")}
ANNUAL = {1: Decimal("24.17"), 2: Decimal("65.83"), 3: Decimal("165.83")}
HOT = 7


def month(d):
    return d.replace(day=1)


def later(d, n):
    return date(d.year + (d.month - 1 + n) // 12, (d.month - 1 + n) % 12 + 1, 1)


CALENDAR = [later(date(2022, 1, 1), n) for n in range(36)]


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(5)
    subs = []
    for i in range(300):
        start = date(2022, 1, 1) + timedelta(days=rng.randrange(1090))
        end = start + timedelta(days=rng.randrange(-20, 400))
        held = end if rng.random() < 0.7 and end <= SNAPSHOT else None
        who = HOT if i % 3 == 0 else rng.randrange(40)
        subs.append((who, rng.choice((1, 2, 3)), start, held, rng.choice(("monthly", "annual"))))
    frame = subscriptions(spark, *[(c, p, s.isoformat(), e and e.isoformat(), k) for c, p, s, e, k in subs]).cache()
    signups = {c: date(2022, 1, 1) + timedelta(days=rng.randrange(700)) for c in range(40)}
    people = customers(
        spark, *[(c, d.isoformat(), rng.choice(("Direct", "Referral")), rng.choice(("India", None))) for c, d in signups.items()]
    ).cache()
    bills = [(rng.randrange(1, 301), str(rng.choice((29, 79, 2900))), rng.choice(("paid", "failed"))) for _ in range(900)]
    bills += [(1, "29.00", "paid")] * 400
    return {
        "list": subs, "subs": frame, "mrr": mrr.subscription_mrr(frame, plans(spark)), "signups": signups,
        "people": people, "plans": plans(spark), "bill_list": bills, "bills": invoices(spark, *bills).cache(),
    }


def price(plan, cycle):
    return PRICE[plan] if cycle == "monthly" else ANNUAL[plan]


def held(world):
    totals = defaultdict(Decimal)
    for c, p, start, end, cycle in world["list"]:
        for m in CALENDAR:
            if start <= m and (end is None or end >= m):
                totals[c, m] += price(p, cycle)
    return totals


def overlapping(world):
    return {
        (c, m) for c, _, start, end, _ in world["list"] for m in CALENDAR
        if month(start) <= m <= month(end or SNAPSHOT)
    }


def test_customer_month_mrr(world):
    found = {(c, m): v for m, c, v in rows(mrr.customer_month_mrr(world["mrr"], snapshot=SNAPSHOT))}
    assert found == held(world)


def test_mrr_waterfall(world):
    expected = defaultdict(lambda: [Decimal(0)] * 4)
    seen = {}
    for (c, m), now in sorted(held(world).items(), key=lambda x: x[0][1]):
        before = seen.get(c)
        place = 0 if before is None else 1 if now > before else 2 if now < before else None
        line = list(expected[m])
        if place is not None:
            line[place] += now - (before or 0)
        line[3] += now
        expected[m], seen[c] = line, now
    found = {m: list(rest) for m, *rest in rows(mrr.mrr_waterfall(world["mrr"], snapshot=SNAPSHOT))}
    assert found == dict(expected)


def test_churn_by_disappearance(world):
    active = held(world)
    found = by(churn.fact_churn_by_month(world["mrr"], snapshot=SNAPSHOT), "month")
    for m in CALENDAR[:-1]:
        here = [c for c, at in active if at == m]
        gone = [c for c in here if (c, later(m, 1)) not in active]
        if here:
            assert (found[m]["active_customers"], found[m]["customers_churned"]) == (len(here), len(gone))
    assert CALENDAR[-1] not in found


def test_churn_by_cancellation(world):
    lost = defaultdict(set)
    for c, _, _, end, _ in world["list"]:
        if end:
            lost[month(end)].add(c)
    active = overlapping(world)
    found = by(churn.monthly_churn(world["mrr"], snapshot=SNAPSHOT), "month")
    assert {m: r["active_customers"] for m, r in found.items()} == {
        m: sum(1 for _, at in active if at == m) for m in {at for _, at in active}
    }
    assert {m: r["customers_churned"] for m, r in found.items()} == {m: len(lost[m]) for m in found}


def test_retention(world):
    counts = defaultdict(set)
    for c, m in overlapping(world):
        start = month(world["signups"][c])
        offset = (m.year - start.year) * 12 + m.month - start.month
        if 0 <= offset <= 12:
            counts[start, offset].add(c)
    kept = cohort.fact_cohort_retention(world["people"], world["subs"], snapshot=SNAPSHOT)
    found = {(r["cohort_month"], r["months_since_signup"]): r["active_customers"] for r in kept.collect()}
    assert found == {k: len(v) for k, v in counts.items()}


def test_lifetime_value(world):
    revenue, first, last = defaultdict(Decimal), {}, {}
    for sub, amount, status in world["bill_list"]:
        if status == "paid":
            c, _, start, end, _ = world["list"][sub - 1]
            revenue[c] += Decimal(amount)
            first[c] = min(first.get(c, start), start)
            last[c] = max(last.get(c, end or SNAPSHOT), end or SNAPSHOT)
    clv = value.fact_customer_clv(world["people"], world["subs"], world["bills"], snapshot=SNAPSHOT)
    found = {r["customer_id"]: (r["total_revenue"], float(r["tenure_months"])) for r in clv.collect()}
    assert set(found) == set(revenue)
    for c, (total, tenure) in found.items():
        assert total == revenue[c]
        assert tenure == pytest.approx((last[c] - first[c]).days / 30.44, abs=0.0501)


def test_three_ways_to_the_same_revenue_agree(world):
    waterfall = mrr.mrr_waterfall(world["mrr"], snapshot=SNAPSHOT).select("month", "total_mrr")
    facts = mrr.fact_monthly_subscription(world["mrr"], snapshot=SNAPSHOT)
    cells = mrr.pivot_source(world["subs"], world["plans"], world["people"], snapshot=SNAPSHOT)
    summary = report.monthly_summary(world["subs"], world["plans"], world["people"], snapshot=SNAPSHOT)
    others = [
        facts.groupBy("month").agg({"mrr": "sum"}).toDF("month", "total_mrr"),
        cells.groupBy("month").agg({"mrr": "sum"}).toDF("month", "total_mrr"),
        summary.select("month", "total_mrr"),
    ]
    for other in others:
        compared = quality.reconcile(waterfall, other, ["month"], ["total_mrr"])
        assert {r["status"] for r in compared.collect()} == {"match"}


def test_the_checkpoints_are_part_of_the_year(world):
    year = set(rows(cohort.fact_cohort_retention(world["people"], world["subs"], snapshot=SNAPSHOT)))
    some = set(rows(cohort.cohort_retention(world["people"], world["subs"], snapshot=SNAPSHOT)))
    assert some and some < year


def test_pivot_keeps_every_value_without_a_list(world):
    cells = mrr.pivot_source(world["subs"], world["plans"], world["people"], snapshot=SNAPSHOT)
    assert set(mrr.mrr_pivot(cells, "plan_tier").columns) == {"month", "Starter", "Professional", "Enterprise"}
    assert set(mrr.mrr_pivot(cells, "acquisition_channel").columns) == {"month", "Direct", "Referral"}
