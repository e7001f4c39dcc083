"""Node allocation and running balances."""

from __future__ import annotations

from tallyspark.functions.exact import ratio_sql
from tallyspark.plans.balances import GROWTH_THRESHOLD_PCT
from tallyspark.sources.adapters import OPEN_END

_CLOSED = f"(SELECT region_id, end_date - start_date AS duration FROM bank_nodes WHERE end_date < DATE '{OPEN_END}')"
_SIGNED = "txn_amount * if(txn_type = 'deposit', 1, -1)"


def _upto(unit: str) -> str:
    """What a customer's transactions add per day or month, and in all up to the end of it: a self-join of the sums."""
    return f"""{unit}s AS (SELECT customer_id, CAST(date_trunc('{unit}', txn_date) AS DATE) AS upto, sum({_SIGNED}) AS change FROM bank_txns GROUP BY ALL),
        {unit}_ends AS (SELECT a.customer_id, a.upto, any_value(a.change) AS change, CAST(sum(b.change) AS BIGINT) AS balance
            FROM {unit}s a JOIN {unit}s b ON b.customer_id = a.customer_id AND b.upto <= a.upto GROUP BY a.customer_id, a.upto)"""


SQL = {
    "bank_region_nodes": "SELECT region_id, node_id FROM bank_nodes GROUP BY ALL",
    "bank_nodes_per_region": "SELECT region_id, len(list_distinct(list(node_id))) AS nodes FROM bank_nodes GROUP BY region_id",
    "bank_customers_per_region_node": """SELECT region_id, node_id, count(*) AS customers
        FROM (SELECT DISTINCT region_id, node_id, customer_id FROM bank_nodes) d GROUP BY ALL""",
    "bank_avg_realloc_days": f"SELECT {ratio_sql('sum(duration)', 'count(duration)', 3)} AS average_days FROM {_CLOSED} c",
    "bank_realloc_percentiles": f"""WITH s AS (SELECT region_id, list_sort(list(duration)) AS d FROM {_CLOSED} c GROUP BY region_id),
        q AS (SELECT region_id, d, unnest([('median', 50), ('p80', 80), ('p95', 95)]) AS p FROM s),
        -- the rank in hundredths: its whole part picks two neighbours, the rest weighs them
        r AS (SELECT region_id, p[1] AS name, d, (len(d) - 1) * p[2] AS h FROM q),
        v AS (SELECT region_id, name, CAST(d[h // 100 + 1] AS DECIMAL(20, 4)) + CAST(d[least(h // 100 + 2, len(d))] - d[h // 100 + 1] AS DECIMAL(18, 0)) * (h % 100) * CAST(0.01 AS DECIMAL(4, 2)) AS x FROM r)
        SELECT region_id, CAST(max(x) FILTER (WHERE name = 'median') AS DECIMAL(24, 4)) AS median,
            CAST(max(x) FILTER (WHERE name = 'p80') AS DECIMAL(24, 4)) AS p80, CAST(max(x) FILTER (WHERE name = 'p95') AS DECIMAL(24, 4)) AS p95
        FROM v GROUP BY region_id""",
    "bank_txn_by_type": "SELECT txn_type, count(*) AS transactions, CAST(sum(txn_amount) AS BIGINT) AS total_amount FROM bank_txns GROUP BY ALL",
    "bank_deposits_by_customer": f"""SELECT customer_id, count(*) AS transactions, {ratio_sql('sum(txn_amount)', 'count(*)', 2)} AS average_amount
        FROM bank_txns GROUP BY customer_id, txn_type HAVING txn_type = 'deposit'""",
    "bank_active_by_month": """SELECT month, count(*) AS customer_count
        FROM (SELECT customer_id, CAST(date_trunc('month', txn_date) AS DATE) AS month, list(txn_type) AS kinds FROM bank_txns GROUP BY ALL) m
        WHERE len(list_filter(kinds, lambda k: k = 'deposit')) > 1 AND list_has_any(kinds, ['purchase', 'withdrawal']) GROUP BY month""",
    "bank_closing_balance": f"""WITH {_upto('month')}
        SELECT customer_id, upto AS month, CAST(change AS BIGINT) AS monthly_balance, balance AS final_month_balance FROM month_ends""",
    "bank_balance_growth_pct": f"""WITH {_upto('month')}, good AS (SELECT customer_id, list(balance ORDER BY upto) AS b FROM month_ends WHERE balance > 0 GROUP BY customer_id),
        up AS (SELECT customer_id FROM good WHERE len(list_filter(range(2, len(b) + 1), lambda i: (b[i] - b[i - 1]) * 100 > b[i - 1] * {GROWTH_THRESHOLD_PCT})) > 0)
        SELECT {ratio_sql('(SELECT count(*) FROM up)', '(SELECT count(DISTINCT customer_id) FROM bank_txns)', 2, 100)} AS cust_perc""",
    "bank_running_balance": f"""WITH {_upto('day')}
        SELECT t.customer_id, t.txn_type, t.txn_amount, {_SIGNED} AS signed_amt, t.txn_date, d.balance AS running_cust_bal
        FROM bank_txns t JOIN day_ends d ON d.customer_id = t.customer_id AND d.upto = t.txn_date""",
    "bank_month_end_balance": f"""WITH {_upto('month')} SELECT customer_id, upto AS month, balance AS cust_end_month_bal FROM month_ends""",
    "bank_balance_stats": f"""WITH {_upto('day')}
        SELECT t.customer_id, min(d.balance) AS min_bal, {ratio_sql('sum(d.balance)', 'count(*)', 2)} AS avg_bal, max(d.balance) AS max_bal
        FROM bank_txns t JOIN day_ends d ON d.customer_id = t.customer_id AND d.upto = t.txn_date GROUP BY t.customer_id""",
}
SQL["bank_balances_in_order"] = f"SELECT row_number() OVER (ORDER BY customer_id, txn_date, txn_type, txn_amount) AS position, b.* FROM ({SQL['bank_running_balance']}) b"
