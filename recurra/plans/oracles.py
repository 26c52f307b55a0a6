"""The SQL each registered query is checked against, for DuckDB over the same source tables.

The texts say the same thing another way: calendars are joined by inequality where the operators explode
ranges, duplicates are found by window where the operators aggregate and join back, distinct counts stay
distinct counts. Only the mapping from the source tables is shared.
"""

from __future__ import annotations

import re

from recurra.functions.text import COUNTRY_SPELLINGS
from recurra.plans.catalog import PROFILED, TIERS
from recurra.schemas import CLEAN, DOMAINS, FOREIGN_KEYS, PRIMARY_KEYS, RAW, REQUIRED
from recurra.sources.derived import MAPPING, SNAPSHOT, SOURCES

_SNAP = f"DATE '{SNAPSHOT.isoformat()}'"


def _units(top: str, bottom: str, digits: int) -> str:
    """top / bottom in units of 10^-digits, half away from zero."""
    t, b = f"CAST({top} AS HUGEINT)", f"CAST({bottom} AS HUGEINT)"
    return f"(sign({t}) * ((abs({t}) * {2 * 10**digits} + {b}) // nullif(2 * {b}, 0)))"


def _rounded(top: str, bottom: str, digits: int) -> str:
    return f"CAST({_units(top, bottom, digits)} AS DOUBLE) / {10**digits}"


def _cents(amount: str) -> str:
    return f"CAST(({amount}) * 100 AS BIGINT)"


def _month(day: str) -> str:
    return f"CAST(date_trunc('month', {day}) AS DATE)"


def _apart(later: str, earlier: str) -> str:
    return f"CAST(datediff('month', {earlier}, {later}) AS INT)"


def _dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def _strip(raw: str) -> str:
    return rf"regexp_replace({raw}, '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g')"


def _date(raw: str) -> str:
    x = _strip(raw)
    shaped = f"regexp_full_match({x}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}')"
    return (
        f"CAST(coalesce(try_strptime({x}, '%Y-%m-%d'), try_strptime({x}, '%d-%b-%Y'), "
        f"CASE WHEN {shaped} AND {_part(x, 2)} <= 12 THEN try_strptime({x}, '%d/%m/%Y') "
        f"WHEN {shaped} THEN try_strptime({x}, '%m/%d/%Y') END) AS DATE)"
    )


def _part(x: str, i: int) -> str:
    return f"TRY_CAST(split_part({x}, '/', {i}) AS INT)"


def _ambiguous(raw: str) -> str:
    x = _strip(raw)
    return f"coalesce({x} LIKE '%/%/%' AND {_part(x, 1)} BETWEEN 1 AND 12 AND {_part(x, 2)} BETWEEN 1 AND 12, FALSE)"


_NAME = r"nullif(trim(regexp_replace(regexp_replace(lower(company_name), '[.,-]', '', 'g'), '\s+', ' ', 'g')), '')"
_SPELLINGS = ", ".join(f"('{k}', '{v}')" for k, v in COUNTRY_SPELLINGS.items())
_TRUE_ID = "(SELECT canonical_customer_id FROM remap WHERE duplicate_customer_id = {t}.customer_id)"


def _true_id(t: str) -> str:
    return f"coalesce({_TRUE_ID.format(t=t)}, {t}.customer_id)"


_RUNNING = "s.start_date <= m.month AND (s.end_date IS NULL OR s.end_date >= m.month)"
_TENTHS = _units("100 * (max(coalesce(s.end_date, " + _SNAP + ")) - min(s.start_date))", "3044", 1)

_DERIVED = {name: text.format(**{n: n for n in (*SOURCES, *MAPPING)}) for name, text in MAPPING.items()}

_CTES = {
    **_DERIVED,
    "spellings": f"SELECT * FROM (VALUES {_SPELLINGS}) v(spelling, country_name)",
    "remap": f"""
        SELECT customer_id AS duplicate_customer_id, lowest AS canonical_customer_id
        FROM (SELECT customer_id, min(customer_id) OVER (PARTITION BY {_NAME}) AS lowest
              FROM raw_customers WHERE {_NAME} IS NOT NULL)
        WHERE customer_id > lowest""",
    "c_customers": f"""
        SELECT customer_id, company_name, country_name AS country, company_size_band,
               {_date('signup_date')} AS signup_date, acquisition_channel,
               {_ambiguous('signup_date')} AS signup_date_ambiguous
        FROM raw_customers LEFT JOIN spellings ON spelling = lower({_strip('country')})
        WHERE customer_id NOT IN (SELECT duplicate_customer_id FROM remap)""",
    "c_plans": """
        SELECT plan_id, plan_name, tier, CAST(monthly_price AS DECIMAL(10,2)) AS monthly_price,
               CAST(annual_price AS DECIMAL(10,2)) AS annual_price FROM raw_plans""",
    "c_subscriptions": f"""
        SELECT subscription_id, {_true_id('r')} AS customer_id, plan_id, {_date('start_date')} AS start_date,
               TRY_CAST(end_date AS DATE) AS end_date, billing_cycle, status
        FROM raw_subscriptions r""",
    "parsed_invoices": f"""
        SELECT invoice_id, subscription_id, {_date('invoice_date')} AS invoice_date, payment_status,
               TRY_CAST(replace(replace(amount, '$', ''), ',', '') AS DECIMAL(12,2)) AS amount,
               contains(amount, '$') OR contains(amount, ',') AS was_formatted
        FROM raw_invoices""",
    "list_prices": """
        SELECT subscription_id, billing_cycle, monthly_price, annual_price,
               CASE billing_cycle WHEN 'monthly' THEN monthly_price ELSE annual_price END AS list_price
        FROM subscriptions JOIN plans USING (plan_id)""",
    "c_invoices": """
        SELECT i.*, coalesce(amount > 5 * list_price OR 5 * amount < list_price, FALSE) AS is_outlier
        FROM parsed_invoices i LEFT JOIN list_prices USING (subscription_id)""",
    "whole_invoices": """
        SELECT invoice_id * 100000 + row_number() OVER (
                   PARTITION BY invoice_id ORDER BY subscription_id, invoice_date, amount, payment_status, is_outlier) AS invoice_id,
               subscription_id, invoice_date, amount, payment_status, is_outlier
        FROM invoices""",
    "other_invoices": """
        SELECT invoice_id, subscription_id, CASE WHEN invoice_id % 997 = 101 THEN amount + 1 ELSE amount END AS amount,
               CASE WHEN invoice_id % 1999 <> 201 THEN payment_status END AS payment_status
        FROM whole_invoices WHERE invoice_id % 2999 <> 301
        UNION ALL SELECT -invoice_id, subscription_id, amount, payment_status FROM whole_invoices WHERE invoice_id % 2003 = 401""",
    "judged_invoices": """
        SELECT i.invoice_id, subscription_id, i.amount, list_price,
               coalesce(amount > 5 * list_price OR 5 * amount < list_price, FALSE) AS is_outlier
        FROM invoices i LEFT JOIN list_prices USING (subscription_id)""",
    "c_usage_monthly": f"""
        SELECT {_true_id('r')} AS customer_id, CAST(month || '-01' AS DATE) AS usage_month,
               CAST(sum(login_count) AS BIGINT) AS login_count,
               CAST(sum(feature_usage_count) AS BIGINT) AS feature_usage_count
        FROM raw_usage_monthly r GROUP BY ALL""",
    "c_support_tickets": f"""
        SELECT ticket_id, {_true_id('r')} AS customer_id, TRY_CAST(created_date AS DATE) AS created_date,
               TRY_CAST(resolved_date AS DATE) AS resolved_date, priority, category
        FROM raw_support_tickets r""",
    "priced": """
        SELECT s.*, p.tier, CASE billing_cycle WHEN 'monthly' THEN monthly_price
               WHEN 'annual' THEN CAST(round(annual_price / 12, 2) AS DECIMAL(10,2)) END AS mrr
        FROM subscriptions s JOIN plans p USING (plan_id)""",
    "calendar": f"""
        SELECT CAST(unnest(generate_series(
                   (SELECT date_trunc('month', min(start_date)) FROM subscriptions),
                   (SELECT date_trunc('month', max(coalesce(end_date, {_SNAP}))) FROM subscriptions),
                   INTERVAL 1 MONTH)) AS DATE) AS month""",
    "report_calendar": f"SELECT month FROM calendar WHERE month <= {_SNAP}",
    "overlapping": f"""
        SELECT m.month, s.* FROM calendar m JOIN priced s
        ON s.start_date < m.month + INTERVAL 1 MONTH AND coalesce(s.end_date, {_SNAP}) >= m.month""",
    "held": f"""
        SELECT m.month, s.customer_id, sum(s.mrr) AS mrr
        FROM calendar m JOIN priced s ON {_RUNNING} GROUP BY ALL""",
    "report_held": f"SELECT * FROM held WHERE month <= {_SNAP}",
    "waterfall": """
        SELECT t.*, CASE WHEN mrr = prev_mrr THEN 'unchanged' WHEN mrr > prev_mrr THEN 'expansion'
                         WHEN mrr < prev_mrr THEN 'contraction' ELSE 'new' END AS movement_type,
               CASE WHEN prev_mrr IS NULL THEN mrr ELSE mrr - prev_mrr END AS mrr_delta
        FROM (SELECT h.*, lag(mrr) OVER (PARTITION BY customer_id ORDER BY month) AS prev_mrr FROM {held} h) t""",
    "report_cells": f"""
        SELECT m.month, s.tier AS plan_tier, coalesce(c.acquisition_channel, 'Unknown') AS acquisition_channel,
               c.country, sum(s.mrr) AS mrr, count(DISTINCT s.customer_id) AS active_customers
        FROM report_calendar m JOIN priced s ON {_RUNNING} JOIN customers c USING (customer_id) GROUP BY ALL""",
    "retention_sums": f"""
        SELECT sum(then_mrr) AS then_mrr, sum(coalesce(now_mrr, 0)) AS now_mrr
        FROM (SELECT customer_id, sum(mrr) AS then_mrr FROM priced
              WHERE start_date <= {_SNAP} - INTERVAL 1 YEAR
                AND coalesce(end_date, DATE '9999-12-31') >= {_SNAP} - INTERVAL 1 YEAR GROUP BY customer_id) b
        LEFT JOIN (SELECT customer_id, sum(mrr) AS now_mrr FROM priced WHERE status = 'active' GROUP BY customer_id) n
        USING (customer_id)""",
    "nrr": f"""
        SELECT {_dbl('then_mrr')} AS starting_mrr_12mo_ago, {_dbl('now_mrr')} AS same_customers_mrr_now,
               {_rounded('100 * ' + _cents('now_mrr'), _cents('then_mrr'), 1)} AS net_revenue_retention_pct
        FROM retention_sums""",
    "ended": f"SELECT {_month('end_date')} AS month, customer_id, mrr FROM priced WHERE status = 'cancelled'",
    "active_by_month": "SELECT month, count(DISTINCT customer_id) AS active_customers FROM overlapping GROUP BY month",
    "ended_by_month": """
        SELECT month, count(DISTINCT customer_id) AS customers_cancelled, sum(mrr) AS churned_mrr
        FROM ended WHERE month IS NOT NULL GROUP BY month""",
    "monthly_churn": f"""
        SELECT a.month, a.active_customers, coalesce(customers_cancelled, 0) AS customers_churned,
               {_rounded('100 * coalesce(customers_cancelled, 0)', 'active_customers', 2)} AS logo_churn_rate_pct,
               {_dbl('coalesce(churned_mrr, 0)')} AS churned_mrr
        FROM active_by_month a LEFT JOIN ended_by_month USING (month)""",
    "seen": """
        SELECT month, customer_id, sum(mrr) AS mrr FROM
            (SELECT DISTINCT m.month, s.customer_id, s.mrr FROM report_calendar m JOIN priced s ON """
    + _RUNNING
    + """) GROUP BY ALL""",
    "vanished": f"""
        SELECT a.month, count(*) AS active_customers, count(*) FILTER (b.month IS NULL) AS customers_churned,
               {_dbl('coalesce(sum(a.mrr) FILTER (b.month IS NULL), 0)')} AS churned_mrr,
               {_rounded('100 * count(*) FILTER (b.month IS NULL)', 'count(*)', 2)} AS logo_churn_rate_pct
        FROM seen a LEFT JOIN seen b ON b.customer_id = a.customer_id AND b.month = a.month + INTERVAL 1 MONTH
        WHERE a.month < (SELECT max(month) FROM report_calendar) GROUP BY a.month""",
    "sizes": f"SELECT {_month('signup_date')} AS cohort_month, count(*) AS cohort_size FROM customers GROUP BY ALL",
    "kept": f"""
        SELECT z.cohort_month, z.cohort_size, {_apart('o.month', 'z.cohort_month')} AS months_since_signup,
               count(DISTINCT o.customer_id) AS active_customers
        FROM overlapping o JOIN customers c USING (customer_id) JOIN sizes z ON z.cohort_month = {_month('c.signup_date')}
        GROUP BY ALL""",
    "year_kept": "SELECT * FROM kept WHERE months_since_signup BETWEEN 0 AND 12",
    "m12": f"""
        SELECT cohort_month, {_units('100 * coalesce(max(CASE WHEN months_since_signup = 12 THEN active_customers END), 0)',
                                     'max(cohort_size)', 6)} AS micros
        FROM year_kept WHERE {_apart(_SNAP, 'cohort_month')} >= 12 GROUP BY cohort_month""",
    "clv": f"""
        SELECT c.customer_id, c.country, c.company_size_band, c.acquisition_channel, sum(i.amount) AS total_revenue,
               {_TENTHS} AS tenths
        FROM customers c JOIN subscriptions s USING (customer_id)
             JOIN invoices i ON i.subscription_id = s.subscription_id AND i.payment_status = 'paid'
        GROUP BY ALL""",
    "tier_clv": f"""
        SELECT s.customer_id, s.tier AS plan_tier, sum(i.amount) AS total_revenue, {_TENTHS} AS tenths
        FROM priced s JOIN invoices i ON i.subscription_id = s.subscription_id AND i.payment_status = 'paid'
        GROUP BY ALL""",
    "recent_usage": """
        SELECT customer_id, usage_month, login_count, sum(login_count) OVER w AS logins, count(*) OVER w AS n
        FROM usage_monthly WINDOW w AS (PARTITION BY customer_id ORDER BY usage_month ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""",
    "tenures": f"""
        SELECT customer_id, min(start_date) AS first_start, max(end_date) AS last_end,
               bool_or(status = 'active') AS still_active,
               CASE WHEN bool_or(status = 'active') THEN {_SNAP} ELSE max(end_date) END AS end_for_tenure,
               end_for_tenure - first_start AS days
        FROM subscriptions GROUP BY customer_id""",
    "day_bounds": "SELECT min(days) AS lo, max(days) AS hi FROM tenures",
    "revenues": """
        SELECT s.customer_id, coalesce(sum(i.amount), 0) AS total_revenue
        FROM subscriptions s LEFT JOIN invoices i
             ON i.subscription_id = s.subscription_id AND i.payment_status = 'paid' GROUP BY s.customer_id""",
    "arpus": f"""
        SELECT customer_id, total_revenue, days,
               {_units('3044 * ' + _cents('total_revenue'), '100 * greatest(days * 100, 3044)', 6)} AS micros
        FROM revenues JOIN tenures USING (customer_id)""",
    "ranked_arpus": "SELECT micros, row_number() OVER (ORDER BY micros) - 1 AS place, count(*) OVER () AS n FROM arpus",
    "arpu_cap": """
        SELECT max(CASE WHEN place = 99 * (n - 1) // 100 THEN micros END) AS low,
               max(CASE WHEN place = least(99 * (n - 1) // 100 + 1, n - 1) THEN micros END) AS high,
               max(99 * (n - 1) % 100) AS part, low * 100 + (high - low) * part AS cap FROM ranked_arpus""",
    "capped_arpus": "SELECT least(micros * 100, cap) AS v FROM arpus, arpu_cap",
    "arpu_bounds": "SELECT min(v) AS lo, max(v) AS hi FROM capped_arpus",
    "last_cancelled": """
        SELECT customer_id, max(end_date) AS churned_on FROM subscriptions WHERE status = 'cancelled' GROUP BY customer_id""",
    "before_churn": f"""
        SELECT months_before_churn, CAST(sum(login_count) AS DOUBLE) / count(*) AS avg_logins
        FROM (SELECT {_apart('churned_on', 'usage_month')} AS months_before_churn, login_count
              FROM usage_monthly JOIN last_cancelled USING (customer_id))
        WHERE months_before_churn BETWEEN 0 AND 6 GROUP BY months_before_churn""",
    "price_check": """
        SELECT i.invoice_id, CASE billing_cycle WHEN 'monthly' THEN CAST(monthly_price AS DOUBLE)
               ELSE CAST(annual_price AS DOUBLE) / 12 END AS expected_price, i.amount, i.is_outlier
        FROM invoices i JOIN list_prices USING (subscription_id)""",
    "report_months": """
        SELECT CAST(unnest(generate_series((SELECT min(month) FROM report_cells),
                                           (SELECT max(month) FROM report_cells), INTERVAL 1 MONTH)) AS DATE) AS month""",
    "summary": """
        SELECT m.month, coalesce(t.mrr, 0) AS total_mrr, coalesce(t.n, 0) AS active_customers,
               coalesce(h.n, 0) AS active_customers_distinct, coalesce(e.customers_cancelled, 0) AS customers_cancelled,
               coalesce(e.churned_mrr, 0) AS churned_mrr,
               lag(coalesce(t.mrr, 0)) OVER (ORDER BY m.month) AS before
        FROM report_months m
        LEFT JOIN (SELECT month, sum(mrr) AS mrr, CAST(sum(active_customers) AS BIGINT) AS n FROM report_cells GROUP BY month) t
             ON t.month = m.month
        LEFT JOIN (SELECT month, count(*) AS n FROM report_held GROUP BY month) h ON h.month = m.month
        LEFT JOIN ended_by_month e ON e.month = m.month""",
    "monthly_summary": f"""
        SELECT month, {_dbl('total_mrr')} AS total_mrr, active_customers, active_customers_distinct, customers_cancelled,
               {_dbl('churned_mrr')} AS churned_mrr,
               coalesce({_dbl('customers_cancelled')} / nullif(active_customers, 0), 0) AS logo_churn_rate,
               {_dbl(_cents("total_mrr - before"))} / nullif({_cents('before')}, 0) AS mom_growth_pct
        FROM summary""",
}
_CTES["report_waterfall"] = _CTES["waterfall"].replace("{held}", "report_held")
_CTES["waterfall"] = _CTES["waterfall"].replace("{held}", "held")


def _bins(rows: str, value: str, bounds: str, bins: int, unit: str) -> str:
    place = f"least({bins}, 1 + ({value} - lo) * {bins} // greatest(hi - lo, 1))"
    return f"""
        SELECT CAST(b.bin AS INT) AS bin, CAST(lo * {bins} + (hi - lo) * (b.bin - 1) AS DOUBLE) / {bins} / {unit} AS bin_low,
               CAST(lo * {bins} + (hi - lo) * b.bin AS DOUBLE) / {bins} / {unit} AS bin_high, coalesce(f.n, 0) AS n
        FROM {bounds}, (SELECT unnest(generate_series(1, {bins})) AS bin) b
        LEFT JOIN (SELECT {place} AS bin, count(*) AS n FROM {rows}, {bounds} GROUP BY ALL) f ON f.bin = b.bin"""


def _null_count(column: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, count(*) FILTER ({column} IS NULL) AS n_missing, "
        f"{_rounded(f'100 * count(*) FILTER ({column} IS NULL)', 'count(*)', 1)} AS pct_missing FROM raw_customers"
    )


def _log(table: str, metric: str, expression: str, source: str) -> str:
    return f"SELECT '{table}' AS table_name, '{metric}' AS metric, CAST({expression} AS BIGINT) AS value FROM {source}"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _cleaning_log() -> str:
    rows = [
        _log(t, m, "count(*)", s)
        for t in CLEAN
        for m, s in (("rows_in", f"raw_{t}"), ("rows_out", f"c_{t}"))
    ]
    known = f"raw_customers LEFT JOIN spellings ON spelling = lower({_strip('country')})"
    return _union(
        rows
        + [
            _log("customers", "raw_countries", "count(DISTINCT country)", "raw_customers"),
            _log("customers", "canonical_countries", "count(DISTINCT country_name)", known),
            _log("customers", "unmapped_countries", "count(*) FILTER (country_name IS NULL)", known),
            _log("customers", "ambiguous_dates", f"count(*) FILTER ({_ambiguous('signup_date')})", "raw_customers"),
            _log("customers", "failed_dates", f"count(*) FILTER ({_date('signup_date')} IS NULL)", "raw_customers"),
            _log("customers", "missing_company_size_band", "count(*) - count(company_size_band)", "raw_customers"),
            _log("customers", "missing_acquisition_channel", "count(*) - count(acquisition_channel)", "raw_customers"),
            _log("customers", "merged_duplicates", "count(*)", "remap"),
            _log("subscriptions", "ambiguous_dates", f"count(*) FILTER ({_ambiguous('start_date')})", "raw_subscriptions"),
            _log("subscriptions", "failed_dates", f"count(*) FILTER ({_date('start_date')} IS NULL)", "raw_subscriptions"),
            _log("invoices", "formatted_amounts", "count(*) FILTER (was_formatted)", "c_invoices"),
            _log("invoices", "failed_amounts", "count(*) - count(amount)", "c_invoices"),
            _log("invoices", "outliers", "count(*) FILTER (is_outlier)", "c_invoices"),
            _log("invoices", "failed_dates", "count(*) - count(invoice_date)", "c_invoices"),
        ]
    )


def _duplicates(table: str, keys: tuple[str, ...], source: str, label: str) -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        f"SELECT {label}, count(*) AS n_duplicate_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_surplus_rows, "
        f"(SELECT count(*) FROM {source} WHERE NOT ({present})) AS n_null_keys FROM "
        f"(SELECT count(*) AS n FROM {source} WHERE {present} GROUP BY {', '.join(keys)}) WHERE n > 1"
    )


def _orphans(child: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT count(*) FROM {child} k WHERE {column} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = k.{column})"
    )


def _domain_violations() -> str:
    parts = []
    for table in CLEAN:
        rules = {f"{c} is required": f"{c} IS NULL" for c in REQUIRED[table]}
        for c, values in DOMAINS.get(table, {}).items():
            listed = ", ".join(f"'{v}'" for v in values)
            rules[f"{c} in {', '.join(values)}"] = f"{c} NOT IN ({listed})"
        parts += [
            f"SELECT '{table}' AS table_name, '{rule}' AS rule, count(*) AS n_violations FROM c_{table} WHERE {broken}"
            for rule, broken in rules.items()
        ]
    return _union(parts)


def _reconcile(measures: tuple[str, ...], left: str, right: str) -> str:
    parts = []
    for m in measures:
        parts.append(
            f"""SELECT month, '{m}' AS measure, {_dbl('a.' + m)} AS left_value, {_dbl('b.' + m)} AS right_value,
                CAST(CAST(a.{m} AS DECIMAL(28,6)) - CAST(b.{m} AS DECIMAL(28,6)) AS DOUBLE) AS difference,
                CASE WHEN b.month IS NULL THEN 'left_only' WHEN a.month IS NULL THEN 'right_only'
                     WHEN a.{m} = b.{m} THEN 'match' ELSE 'diff' END AS status
                FROM {left} a FULL JOIN {right} b USING (month)"""
        )
    return _union(parts)


def _cells(table: str, columns: list[str], source: str, hundredths: tuple[str, ...] = ()) -> str:
    filled = " + ".join(f"count({c})" for c in columns)
    texts = ", ".join(f"coalesce(CAST({f'CAST(round({c} * 100) AS BIGINT)' if c in hundredths else c} AS VARCHAR), '~')" for c in columns)
    digest = f"CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {texts})), 1, 8) AS BIGINT)) AS BIGINT)"
    return f"SELECT '{table}' AS table_name, count(*) AS n_rows, {filled} AS n_values, {digest} AS digest FROM {source}"


def _clv_by(segment: str, source: str = "clv") -> str:
    return f"""
        SELECT coalesce({segment}, 'Unknown') AS {segment}, count(*) AS customers,
               {_rounded(_cents('sum(total_revenue)'), '100 * count(*)', 2)} AS avg_clv,
               {_rounded('sum(tenths)', '10 * count(*)', 1)} AS avg_tenure_months,
               {_dbl('sum(total_revenue)')} AS total_revenue_from_segment
        FROM {source} GROUP BY {source}.{segment}"""


def _matrix() -> str:
    cells = []
    for k in range(13):
        share = _rounded(
            f"100 * coalesce(max(CASE WHEN months_since_signup = {k} THEN active_customers END), 0)", "max(z.cohort_size)", 1
        )
        cells.append(f"CASE WHEN {_apart(_SNAP, 'cohort_month')} >= {k} THEN {share} END AS m{k}")
    return (
        f"SELECT cohort_month, {', '.join(cells)} FROM sizes z LEFT JOIN year_kept USING (cohort_month) "
        "WHERE cohort_month IS NOT NULL GROUP BY cohort_month ORDER BY cohort_month DESC LIMIT 18"
    )


def _kept(condition: str) -> str:
    return f"""
        SELECT *, {_rounded('100 * active_customers', 'cohort_size', 1)} AS retention_pct
        FROM year_kept WHERE {condition}"""


_CLV = f"""
    SELECT customer_id, country, company_size_band, acquisition_channel, {_dbl('total_revenue')} AS total_revenue,
           CAST(tenths AS DOUBLE) / 10 AS tenure_months FROM clv"""
_TENURE_SUMMARY = "SELECT quantile_cont(days, 0.5) / 30.44 AS median, CAST(sum(days) AS DOUBLE) / count(days) / 30.44 AS mean FROM tenures"
_ARPU_SUMMARY = (
    "SELECT quantile_cont(CAST(micros AS BIGINT), 0.5) / 1000000 AS median, "
    "CAST(sum(micros) AS DOUBLE) / count(*) / 1000000 AS mean FROM arpus"
)
_M12_SUMMARY = f"""
    SELECT CAST(min(micros) AS DOUBLE) / 1000000 AS min_pct, CAST(max(micros) AS DOUBLE) / 1000000 AS max_pct,
           {_rounded('sum(micros)', '1000000 * count(*)', 4)} AS mean_pct, count(*) AS n_cohorts FROM m12"""
_USAGE_DROP = """
    SELECT a.avg_logins AS logins_6_out, b.avg_logins AS logins_final,
           (b.avg_logins - a.avg_logins) / a.avg_logins * 100 AS drop_pct
    FROM before_churn a, before_churn b WHERE a.months_before_churn = 6 AND b.months_before_churn = 0"""
_OUTLIER_SHARE = f"""
    SELECT count(*) FILTER (is_outlier) AS n_outliers, count(*) AS n_invoices,
           {_rounded('100 * count(*) FILTER (is_outlier)', 'count(*)', 1)} AS outlier_pct FROM price_check"""
_SUBSCRIPTION_MRR = f"""
    SELECT subscription_id, customer_id, plan_id, billing_cycle, start_date, end_date, status, {_dbl('mrr')} AS mrr FROM priced"""
_SAMPLE_COLUMNS = "invoice_id, CAST(round(expected_price * 100) AS BIGINT) AS expected_price_cents, amount, is_outlier"


def _metrics() -> str:
    jobs = {
        "missing_pct": (
            ("company_size_band", "acquisition_channel"),
            "SELECT "
            + ", ".join(
                f"{_rounded(f'100 * (count(*) - count({c}))', 'count(*)', 1)} AS {c}"
                for c in ("company_size_band", "acquisition_channel")
            )
            + " FROM customers",
        ),
        "tenure_months": (("median", "mean"), _TENURE_SUMMARY),
        "arpu": (("median", "mean"), _ARPU_SUMMARY),
        "retention_m12": (("min_pct", "max_pct", "mean_pct", "n_cohorts"), _M12_SUMMARY),
        "usage_before_churn": (("logins_6_out", "logins_final", "drop_pct"), _USAGE_DROP),
        "outliers": (("n_outliers", "n_invoices", "outlier_pct"), _OUTLIER_SHARE),
    }
    return _union(
        [
            f"SELECT '{job}' AS job, '{c}' AS metric, {_dbl(c)} AS value FROM ({text})"
            for job, (columns, text) in jobs.items()
            for c in columns
        ]
        + [f"SELECT 'cleaning' AS job, table_name || '.' || metric AS metric, {_dbl('value')} AS value FROM ({_cleaning_log()})"]
    )


def _money(columns: str, source: str, *money: str) -> str:
    return f"SELECT {columns}, {', '.join(f'{_dbl(m)} AS {m}' for m in money)} FROM {source}"


_QUERIES = {
    "register_views": _SUBSCRIPTION_MRR,
    "metrics_table": _metrics(),
    "clean_country": f"SELECT customer_id, country_name AS country FROM raw_customers LEFT JOIN spellings ON spelling = lower({_strip('country')})",
    "parse_messy_date": f"SELECT customer_id, {_date('signup_date')} AS signup_date, {_ambiguous('signup_date')} AS signup_date_ambiguous FROM raw_customers",
    "null_profile": _union([_null_count(c) for c in PROFILED]),
    "normalize_name": f"SELECT customer_id, {_NAME} AS norm_name FROM raw_customers",
    "customer_remap": "SELECT * FROM remap",
    "clean_customers": "SELECT * FROM c_customers",
    "remap_customer_id": "SELECT subscription_id, customer_id FROM c_subscriptions",
    "clean_subscriptions": "SELECT * FROM c_subscriptions",
    "clean_amount": _money("invoice_id, subscription_id, was_formatted", "parsed_invoices", "amount"),
    "flag_invoice_outliers": f"SELECT invoice_id, subscription_id, {_dbl('amount')} AS amount, {_dbl('list_price')} AS expected_price, is_outlier FROM judged_invoices",
    "clean_invoices": _money("invoice_id, subscription_id, invoice_date, payment_status, is_outlier", "c_invoices", "amount"),
    "clean_usage": "SELECT * FROM c_usage_monthly",
    "clean_tickets": "SELECT * FROM c_support_tickets",
    "cleaning_log": _cleaning_log(),
    "clean_plans": _money("plan_id, plan_name, tier", "c_plans", "monthly_price", "annual_price"),
    "pk_violations": _union(
        [_duplicates(t, keys, f"c_{t}", f"'{t}' AS table_name") for t, keys in PRIMARY_KEYS.items()]
    ),
    "fk_orphans": _union(
        [
            f"SELECT '{child}' AS child_table, '{column}' AS fk_column, ({_orphans(f'c_{child}', column, f'c_{parent}', key)}) AS n_orphans"
            for child, column, parent, key in FOREIGN_KEYS
        ]
    ),
    "domain_violations": _domain_violations(),
    "table_row_counts": _union([f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM c_{t}" for t in CLEAN]),
    "reconcile": _reconcile(("active_customers", "customers_churned", "churned_mrr"), "monthly_churn", "vanished"),
    "reconcile_mrr": _reconcile(
        ("total_mrr",), "(SELECT month, sum(mrr) AS total_mrr FROM waterfall GROUP BY month)", "(SELECT month, total_mrr FROM summary)"
    ),
    "subscription_mrr": _SUBSCRIPTION_MRR,
    "month_spine": "SELECT month FROM calendar",
    "active_month_start": f"SELECT s.subscription_id, s.customer_id, m.month FROM calendar m JOIN subscriptions s ON {_RUNNING}",
    "active_overlap": "SELECT subscription_id, customer_id, month FROM overlapping",
    "customer_month_mrr": _money("month, customer_id", "held", "mrr"),
    "fact_mrr_waterfall": _money("month, customer_id, movement_type", "report_waterfall", "mrr", "prev_mrr", "mrr_delta"),
    "mrr_waterfall": f"""
        SELECT month, {', '.join(f"{_dbl(f"coalesce(sum(mrr_delta) FILTER (movement_type = '{k}'), 0)")} AS {k}_mrr" for k in ('new', 'expansion', 'contraction'))},
               {_dbl('sum(mrr)')} AS total_mrr FROM waterfall GROUP BY month""",
    "fact_monthly_subscription": f"""
        SELECT m.month, s.customer_id, s.plan_id, {_dbl('sum(s.mrr)')} AS mrr
        FROM report_calendar m JOIN priced s ON {_RUNNING} GROUP BY ALL""",
    "pivot_source": _money("month, plan_tier, acquisition_channel, country, active_customers", "report_cells", "mrr"),
    "mrr_pivot": f"""
        SELECT month, {', '.join(f"{_dbl(f"sum(mrr) FILTER (plan_tier = '{t}')")} AS {t}" for t in TIERS)}
        FROM report_cells GROUP BY month""",
    "net_revenue_retention": "SELECT * FROM nrr",
    "nrr_gap_value": f"""
        SELECT {_dbl('total')} AS current_mrr, net_revenue_retention_pct,
               {_rounded(f"{_cents('total')} * (1000 - CAST(round(net_revenue_retention_pct * 10) AS BIGINT))", '1000', 0)} / 100 AS gap_value
        FROM nrr, (SELECT sum(mrr) AS total FROM held WHERE month = (SELECT max(month) FROM held))""",
    "active_customers_by_month": "SELECT * FROM active_by_month",
    "cancellations": f"SELECT month AS churn_month, customer_id, {_dbl('mrr')} AS churned_mrr FROM ended",
    "monthly_churn": "SELECT * FROM monthly_churn",
    "fact_churn_by_month": "SELECT * FROM vanished",
    "cancellations_by_month": _money("month, customers_cancelled", "ended_by_month", "churned_mrr"),
    "cohort_sizes": "SELECT * FROM sizes",
    "cohort_retention": _kept("months_since_signup IN (0, 1, 3, 6, 12)"),
    "fact_cohort_retention": _kept("TRUE"),
    "cohort_retention_matrix": _matrix(),
    "cohort_m12_summary": _M12_SUMMARY,
    "fact_customer_clv": _CLV,
    "clv_by_channel": _clv_by("acquisition_channel"),
    "clv_by_size_band": _clv_by("company_size_band"),
    "clv_by_country": _clv_by("country"),
    "clv_by_plan_tier": _clv_by("plan_tier", "tier_clv"),
    "trailing_usage": """
        SELECT customer_id, usage_month, login_count, CAST(logins AS DOUBLE) / nullif(n, 0) AS trailing_avg_logins FROM recent_usage""",
    "revenue_at_risk": f"""
        SELECT customer_id, company_name, login_count AS latest_logins, {_rounded('logins', 'n', 1)} AS trailing_avg_logins,
               {_rounded('100 * (login_count * n - logins)', 'logins', 1)} AS pct_change_in_usage, {_dbl('sum(mrr)')} AS at_risk_mrr
        FROM recent_usage JOIN customers USING (customer_id) JOIN priced USING (customer_id)
        WHERE usage_month = (SELECT max(usage_month) FROM usage_monthly) AND login_count < 0.5 * logins / n AND status = 'active'
        GROUP BY customer_id, company_name, login_count, logins, n
        ORDER BY at_risk_mrr DESC, customer_id LIMIT 20""",
    "customer_tenure": """
        SELECT customer_id, first_start, last_end, still_active, end_for_tenure, days / 30.44 AS tenure_months FROM tenures""",
    "tenure_summary": _TENURE_SUMMARY,
    "tenure_histogram": _bins("tenures", "days", "day_bounds", 30, "30.44"),
    "customer_arpu": f"""
        SELECT customer_id, {_dbl('total_revenue')} AS total_revenue, days / 30.44 AS tenure_months,
               CAST(micros AS DOUBLE) / 1000000 AS arpu FROM arpus""",
    "arpu_summary": _ARPU_SUMMARY,
    "arpu_histogram": _bins("capped_arpus", "v", "arpu_bounds", 40, "100000000"),
    "usage_churn_group": """
        SELECT customer_id, usage_month, login_count, CASE WHEN customer_id IN (SELECT customer_id FROM last_cancelled)
               THEN 'Churned (ever)' ELSE 'Never churned' END AS group_label FROM usage_monthly""",
    "usage_before_churn": "SELECT * FROM before_churn",
    "usage_drop_pct": _USAGE_DROP,
    "invoice_price_check": f"SELECT invoice_id, expected_price, {_dbl('amount')} AS amount, is_outlier FROM price_check",
    "outlier_share": _OUTLIER_SHARE,
    "invoice_sample": f"""
        SELECT invoice_id, expected_price_cents, {_dbl('amount')} AS amount, is_outlier
        FROM (SELECT {_SAMPLE_COLUMNS} FROM price_check)
        ORDER BY md5(concat_ws('|', '1', invoice_id, expected_price_cents, amount, is_outlier)) LIMIT 3000""",
    "dim_customer": "SELECT customer_id, company_name, country, company_size_band, acquisition_channel, signup_date FROM customers",
    "dim_plan": _money("plan_id, plan_name, tier", "plans", "monthly_price", "annual_price"),
    "star_relationships": _union(
        [
            f"SELECT '{label}.{key} is unique' AS relationship, n_surplus_rows AS n_violations FROM "
            f"({_duplicates(label, (key,), source, '1')})"
            for label, key, source in (
                ("dim_customer", "customer_id", "customers"), ("dim_plan", "plan_id", "plans"),
                ("fact_customer_clv", "customer_id", "clv"),
            )
        ]
        + [
            f"SELECT '{fact}.{key} is in {dim}' AS relationship, ({_orphans(source, key, parent, key)}) AS n_violations"
            for fact, key, dim, source, parent in (
                ("fact_monthly_subscription", "customer_id", "dim_customer", "report_held", "customers"),
                ("fact_mrr_waterfall", "customer_id", "dim_customer", "report_waterfall", "customers"),
                ("fact_customer_clv", "customer_id", "dim_customer", "clv", "customers"),
                ("fact_monthly_subscription", "plan_id", "dim_plan", "priced", "plans"),
            )
        ]
    ),
    "monthly_summary": "SELECT * FROM monthly_summary",
    "business_review": """
        SELECT month, total_mrr, active_customers, logo_churn_rate, mom_growth_pct,
               CASE WHEN logo_churn_rate > 0.05 THEN 'red' ELSE 'green' END AS churn_flag,
               CASE WHEN mom_growth_pct < 0 THEN 'red' WHEN mom_growth_pct >= 0 THEN 'green' END AS growth_flag
        FROM monthly_summary ORDER BY month DESC LIMIT 1""",
}


_RETENTION = ["cohort_month", "cohort_size", "months_since_signup", "active_customers", "retention_pct"]
_STAR = {
    "dim_customer": ["customer_id", "company_name", "country", "company_size_band", "acquisition_channel", "signup_date"],
    "dim_plan": ["plan_id", "plan_name", "tier", "monthly_price", "annual_price"],
    "fact_monthly_subscription": ["month", "customer_id", "plan_id", "mrr"],
    "fact_mrr_waterfall": ["month", "customer_id", "mrr", "prev_mrr", "movement_type", "mrr_delta"],
    "fact_churn_by_month": ["month", "active_customers", "customers_churned", "churned_mrr", "logo_churn_rate_pct"],
    "fact_cohort_retention": _RETENTION,
    "fact_customer_clv": [
        "customer_id", "country", "company_size_band", "acquisition_channel", "total_revenue", "tenure_months"
    ],
}
# Columns that the stored tables hold as decimals or doubles.
_MONEY = ("amount", "monthly_price", "annual_price")
_INEXACT = (*_MONEY, "mrr", "prev_mrr", "mrr_delta", "churned_mrr", "logo_churn_rate_pct", "retention_pct", "total_revenue", "tenure_months")
_WHOLE_SET = _union([_cells(t, CLEAN[t].names, "whole_invoices" if t == "invoices" else t, _MONEY) for t in CLEAN])
_QUERIES |= {
    "read_raw": _union([_cells(t, RAW[t].names, f"raw_{t}") for t in RAW]),
    "read_clean": _union([_cells(t, CLEAN[t].names, t, _MONEY) for t in CLEAN]),
    "write_clean": _union([_cells(t, CLEAN[t].names, f"c_{t}", _MONEY) for t in CLEAN]),
    "publish_tables": _WHOLE_SET,
    "publish_run": _WHOLE_SET,
    "publish_star": _union([_cells(t, columns, f"({_QUERIES[t]})", _INEXACT) for t, columns in _STAR.items()]),
    "run_cleaning": _union([_cleaning_log(), *[_log(t, "malformed_rows", "0", "(SELECT 1) one") for t in CLEAN]]),
    "refresh_by_month": f"""
        SELECT month, CASE WHEN count(*) FILTER (late) = 0 THEN 'same' WHEN count(*) FILTER (NOT late) = 0 THEN 'added' ELSE 'rewritten' END AS status,
               count(*) AS n_rows, CAST(round(sum(mrr) * 100) AS BIGINT) AS cents
        FROM (SELECT *, plan_id = 2 AND month(month) % 2 = 0 AS late FROM ({_QUERIES['fact_monthly_subscription']})) GROUP BY month""",
    "compare_tables": """
        SELECT coalesce(a.invoice_id, b.invoice_id) AS invoice_id,
               CASE WHEN b.invoice_id IS NULL THEN 'left_only' WHEN a.invoice_id IS NULL THEN 'right_only' ELSE 'diff' END AS status,
               CASE WHEN a.invoice_id IS NULL OR b.invoice_id IS NULL THEN '' ELSE concat_ws(',',
                   CASE WHEN a.subscription_id IS DISTINCT FROM b.subscription_id THEN 'subscription_id' END,
                   CASE WHEN a.amount IS DISTINCT FROM b.amount THEN 'amount' END,
                   CASE WHEN a.payment_status IS DISTINCT FROM b.payment_status THEN 'payment_status' END) END AS columns
        FROM whole_invoices a FULL JOIN other_invoices b ON a.invoice_id = b.invoice_id
        WHERE a.invoice_id IS NULL OR b.invoice_id IS NULL OR a.subscription_id IS DISTINCT FROM b.subscription_id
              OR a.amount IS DISTINCT FROM b.amount OR a.payment_status IS DISTINCT FROM b.payment_status""",
    "reconcile_metrics": _union([
        f"SELECT '{t}' AS table_name, 'rows_out' AS measure, {_dbl('count(*)')} AS left_value, {_dbl('count(*)')} AS right_value, {_dbl('0')} AS difference, 'match' AS status FROM c_{t}"
        for t in CLEAN
    ]),
    "overlapping_tickets": f"""
        SELECT week, count(*) AS open_tickets,
               CAST(sum(datediff('day', greatest(created_date, week), least(closed_date, sunday)) + 1) AS BIGINT) AS open_days
        FROM (SELECT CAST(d AS DATE) AS week, CAST(d + INTERVAL 6 DAY AS DATE) AS sunday
              FROM generate_series(TIMESTAMP '1992-01-06', TIMESTAMP '2030-12-30', INTERVAL 7 DAY) g(d)) weeks
        JOIN (SELECT created_date, coalesce(resolved_date, {_SNAP}) AS closed_date FROM support_tickets) tickets
          ON created_date <= sunday AND week <= closed_date AND created_date <= closed_date
        GROUP BY week""",
    "active_by_overlap": f"""
        SELECT month, plan_id, count(DISTINCT customer_id) AS active_customers, count(*) AS subscriptions
        FROM calendar JOIN subscriptions ON start_date <= last_day(month) AND coalesce(end_date, {_SNAP}) >= month AND start_date <= coalesce(end_date, {_SNAP})
        GROUP BY month, plan_id""",
    "sketched_customers": """
        SELECT CAST(year(usage_month) AS INT) AS year, count(DISTINCT customer_id) AS customers, TRUE AS within_bound FROM usage_monthly GROUP BY ALL""",
    "sketched_amounts": """
        SELECT payment_status, CAST(share AS DOUBLE) AS share, count(*) AS n, TRUE AS within_bound
        FROM invoices, (VALUES (0.25), (0.5), (0.75)) shares(share) WHERE amount IS NOT NULL GROUP BY ALL""",
}


def _named(text: str) -> set[str]:
    return set(re.findall(r"[a-z_0-9]+", text)) & set(_CTES)


def _needed(text: str) -> list[str]:
    """The common tables a text needs, each after those it needs itself."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in sorted(_named(_CTES[name]) - {name}):
            visit(other)
        order.append(name)

    for name in sorted(_named(text)):
        visit(name)
    return order


def _complete(text: str) -> str:
    ctes = ",\n".join(f"{name} AS ({_CTES[name].strip()})" for name in _needed(text))
    return f"WITH {ctes}\n{text.strip()}" if ctes else text.strip()


def oracle_sql() -> dict[str, str]:
    return {name: _complete(text) for name, text in _QUERIES.items()}
