"""Subscription lifecycle."""

from __future__ import annotations

from tallyspark.functions.exact import int_div_sql, ratio_sql
from tallyspark.plans.subscriptions import AFTER_YEAR, ANNUAL, BASIC, BUCKET_DAYS, CHURN, PAYMENTS_END, PRO, SECONDS_PER_DAY, SNAPSHOT_DATE, SPANS_SQL, TRIAL, UPGRADE_YEAR

_S = "plan_events"
# a customer's events in order, as one list
_PATHS = f"""paths AS (SELECT customer_id, list({{'p': plan_id, 'd': start_date}} ORDER BY start_date, event_key) AS h FROM {_S} GROUP BY customer_id)"""
_DAYS = f"""waits AS (SELECT customer_id, a - t AS days FROM
            (SELECT customer_id, min(start_date) AS t FROM {_S} WHERE plan_id = {TRIAL} GROUP BY customer_id) x JOIN
            (SELECT customer_id, min(start_date) AS a FROM {_S} WHERE plan_id = {ANNUAL} GROUP BY customer_id) y USING (customer_id) WHERE a > t)"""

SQL = {
    "sub_journey": f"SELECT plan_id, customer_id, start_date, plan_name, price FROM plan_catalog JOIN {_S} USING (plan_id)",
    "sub_customers": f"SELECT count(*) AS customers FROM (SELECT customer_id FROM {_S} WHERE customer_id IS NOT NULL GROUP BY customer_id) c",
    "sub_trials_by_month": f"""SELECT CAST(month(start_date) AS BIGINT) AS month, count(customer_id) FILTER (WHERE plan_id = {TRIAL}) AS trial_plans
        FROM {_S} GROUP BY ALL HAVING trial_plans > 0""",
    "sub_events_after_year": f"""SELECT plan_name, count(*) AS events FROM {_S} JOIN plan_catalog USING (plan_id)
        WHERE start_date >= DATE '{AFTER_YEAR + 1}-01-01' GROUP BY ALL""",
    "sub_churn_pct": f"""WITH c AS (SELECT customer_id, bool_or(plan_id = {CHURN}) AS gone FROM {_S} GROUP BY customer_id)
        SELECT count(*) AS total_customer, count(*) FILTER (WHERE gone) AS churned, {ratio_sql('count(*) FILTER (WHERE gone)', 'count(*)', 1, 100)} AS churn_perc FROM c""",
    "sub_churn_after_trial": f"""WITH {_PATHS}, hit AS (SELECT count(*) FILTER (WHERE h[1].p = {TRIAL} AND h[2].p = {CHURN}) AS churned, count(*) AS n FROM paths)
        SELECT churned, {ratio_sql('churned', 'n', 0, 100)} AS perc FROM hit""",
    "sub_second_plan": f"""WITH {_PATHS}, c AS (SELECT h[2].p AS plan_id, count(*) AS customers FROM paths GROUP BY ALL)
        SELECT plan_id, customers, {ratio_sql('customers', '(SELECT count(*) FROM paths)', 2, 100)} AS percent FROM c WHERE plan_id IS NOT NULL""",
    "sub_active_at_date": f"""WITH {_PATHS}, latest AS (SELECT list_filter(h, lambda e: e.d <= DATE '{SNAPSHOT_DATE}')[-1].p AS plan_id FROM paths),
        c AS (SELECT plan_id, count(*) AS customers FROM latest WHERE plan_id IS NOT NULL GROUP BY plan_id)
        SELECT plan_id, customers, {ratio_sql('customers', '(SELECT sum(customers) FROM c)', 2, 100)} AS percent FROM c""",
    "sub_annual_upgrades": f"""WITH {_PATHS} SELECT count(*) AS customers FROM paths
        WHERE len(list_filter(h[2:], lambda e: e.p = {ANNUAL} AND year(e.d) = {UPGRADE_YEAR})) > 0""",
    "sub_days_to_annual": f"WITH {_DAYS} SELECT {ratio_sql('sum(days)', 'count(*)', 0)} AS avg_days FROM waits",
    "sub_days_to_annual_buckets": f"""WITH {_DAYS}, b AS (SELECT unnest(range(0, (max(days) // {BUCKET_DAYS} + 1) * {BUCKET_DAYS}, {BUCKET_DAYS})) AS r_from FROM waits)
        SELECT CAST(r_from AS BIGINT) AS r_from, CAST(r_from + {BUCKET_DAYS - 1} AS BIGINT) AS r_to,
            {ratio_sql('sum(days)', 'count(days)', 0)} AS average_days, count(days) AS customer_count
        FROM b LEFT JOIN waits ON days - days % {BUCKET_DAYS} = r_from GROUP BY r_from""",
    "sub_days_to_annual_spans": f"""WITH {_DAYS}
        SELECT r_from, r_to, {ratio_sql('sum(days)', 'count(days)', 0)} AS average_days, count(days) AS customer_count
        FROM ({SPANS_SQL}) r LEFT JOIN waits ON days >= r_from AND days <= r_to GROUP BY r_from, r_to""",
    "sub_transitions": f"""WITH {_PATHS} SELECT count(*) AS customers FROM paths
        WHERE len(list_filter(range(1, len(h)), lambda i: h[i].p = {PRO} AND h[i + 1].p = {BASIC} AND year(h[i + 1].d) = {UPGRADE_YEAR})) > 0""",
    # each series by recursion, a month at a time; what was paid before by a self-join of the payments
    "sub_payments": f"""SELECT * FROM (WITH RECURSIVE base AS (SELECT DISTINCT customer_id, plan_id, plan_name, price, start_date
            FROM {_S} JOIN plan_catalog USING (plan_id) WHERE plan_id <> {TRIAL} AND start_date <= DATE '{PAYMENTS_END}'),
        chain AS (SELECT customer_id, list({{'s': start_date, 'p': plan_id}} ORDER BY start_date, plan_id) AS h FROM base GROUP BY customer_id),
        ends AS (SELECT b.*, coalesce(list_filter(h, lambda e: (e.s, e.p) > (b.start_date, b.plan_id))[1].s, DATE '{PAYMENTS_END}') AS until
            FROM base b JOIN chain USING (customer_id)),
        pay AS (SELECT customer_id, plan_id, plan_name, price, until, start_date AS d, 0 AS k FROM ends WHERE plan_id <> {CHURN} AND (plan_id = {ANNUAL} OR start_date <= until)
            UNION ALL
            SELECT customer_id, plan_id, plan_name, price, until, CAST(d + INTERVAL 1 MONTH AS DATE), k + 1 FROM pay
            WHERE plan_id <> {ANNUAL} AND d + INTERVAL 1 MONTH < until),
        paid AS (SELECT customer_id, plan_id, plan_name, price, d, (d - DATE '1970-01-01') * {SECONDS_PER_DAY} + k AS ts FROM pay),
        seen AS (SELECT a.customer_id, a.plan_id, a.plan_name, a.price, a.d, a.ts, 1 + count(*) FILTER (WHERE b.ts < a.ts) AS payment_order,
                max({{'p': b.plan_id, 'ts': b.ts, 'price': b.price}}) FILTER (WHERE (b.plan_id, b.ts) < (a.plan_id, a.ts)) AS last
            FROM paid a JOIN paid b ON b.customer_id = a.customer_id GROUP BY ALL)
        SELECT customer_id, plan_id, plan_name, d AS payment_date, payment_order,
            CAST(price - if(last.p <> plan_id AND {int_div_sql('ts - last.ts', str(SECONDS_PER_DAY))} < 30, last.price, 0) AS DECIMAL(24, 2)) AS amount FROM seen) paid_out""",
    "sub_growth": f"""WITH c AS (SELECT CAST(year(start_date) AS BIGINT) AS year, CAST(month(start_date) AS BIGINT) AS month, count(customer_id) AS n
            FROM {_S} WHERE plan_id <> {CHURN} GROUP BY ALL),
        p AS (SELECT a.year, a.month, any_value(a.n) AS n, arg_max(b.n, (b.year, b.month)) AS past
            FROM c a LEFT JOIN c b ON (b.year, b.month) < (a.year, a.month) GROUP BY a.year, a.month)
        SELECT year, month, n AS current_number_of_customers, past AS past_number_of_customers,
            CAST({int_div_sql('100 * (n - past)', 'past')} AS VARCHAR) || '%' AS growth FROM p""",
}
SQL["sub_journey_in_order"] = f"SELECT row_number() OVER (ORDER BY customer_id, start_date, plan_id) AS position, j.* FROM ({SQL['sub_journey']}) j"
