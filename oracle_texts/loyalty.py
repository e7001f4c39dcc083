"""Purchases and loyalty points."""

from __future__ import annotations

from tallyspark.plans.loyalty import BONUS_DAYS, BONUS_ITEM, POINTS_CUTOFF

_MEMBER_DAYS = """member_days AS (SELECT s.customer_id, s.order_date, count(*) AS n FROM diner_sales s
        JOIN diner_members b ON b.customer_id = s.customer_id WHERE s.order_date >= b.join_date GROUP BY ALL)"""


def _edge(side: str, agg: str) -> str:
    """Items of the member's purchase day next to the join date, on the given side of it."""
    return f"""WITH v AS (SELECT s.customer_id, s.order_date, s.product_id FROM diner_sales s, diner_members b
            WHERE b.customer_id = s.customer_id AND s.order_date {side} b.join_date)
        SELECT v.customer_id, m.product_name{', v.order_date' if agg == 'max' else ''} FROM v, diner_menu m
        WHERE m.product_id = v.product_id
          AND (v.customer_id, v.order_date) IN (SELECT customer_id, {agg}(order_date) FROM v GROUP BY customer_id)"""


SQL = {
    "diner_total_spend": """SELECT customer_id, CAST(sum(n * price) AS BIGINT) AS total_amount
        FROM (SELECT customer_id, product_id, count(*) AS n FROM diner_sales GROUP BY ALL) b
        JOIN diner_menu USING (product_id) GROUP BY customer_id""",
    "diner_visit_days": "SELECT customer_id, len(list_distinct(list(order_date))) AS days_visited FROM diner_sales GROUP BY customer_id",
    "diner_first_item": """SELECT s.customer_id, s.order_date, m.product_name FROM diner_sales s, diner_menu m
        WHERE m.product_id = s.product_id
          AND (s.customer_id, s.order_date) IN (SELECT customer_id, min(order_date) FROM diner_sales GROUP BY customer_id)""",
    "diner_top_item": """SELECT arg_min(product_name, (-n, product_name)) AS product_name, max(n) AS purchases
        FROM (SELECT product_name, count(*) AS n FROM diner_sales JOIN diner_menu USING (product_id) GROUP BY product_name) c""",
    "diner_fav_item": """WITH c AS (SELECT customer_id, product_id, count(*) AS n FROM diner_sales GROUP BY ALL)
        SELECT c.customer_id, m.product_name FROM c, diner_menu m
        WHERE m.product_id = c.product_id AND (c.customer_id, c.n) IN (SELECT customer_id, max(n) FROM c GROUP BY customer_id)""",
    "diner_first_after_join": _edge(">=", "min"),
    "diner_last_before_join": _edge("<", "max"),
    "diner_pre_member_totals": """SELECT customer_id, count(price) FILTER (WHERE early) AS items,
            CAST(sum(price) FILTER (WHERE early) AS BIGINT) AS amount
        FROM (SELECT customer_id, price, order_date < join_date AS early
              FROM diner_members JOIN diner_sales USING (customer_id) JOIN diner_menu USING (product_id)) t
        GROUP BY customer_id HAVING bool_or(early)""",
    "diner_points": f"""SELECT customer_id, CAST(sum(10 * price * (1 + CAST(product_name = '{BONUS_ITEM}' AS INTEGER))) AS BIGINT) AS points
        FROM diner_sales JOIN diner_menu USING (product_id) GROUP BY customer_id""",
    "diner_points_bonus_week": f"""SELECT customer_id, CAST(sum(10 * price * (1 + CAST(doubled AS INTEGER))) AS BIGINT) AS points
        FROM (SELECT customer_id, price, product_name = '{BONUS_ITEM}'
                  OR (order_date >= join_date AND order_date <= join_date + {BONUS_DAYS}) AS doubled
              FROM diner_sales JOIN diner_members USING (customer_id) JOIN diner_menu USING (product_id)
              WHERE order_date <= DATE '{POINTS_CUTOFF}') t
        GROUP BY customer_id""",
    "diner_member_ranked": f"""WITH {_MEMBER_DAYS},
        ranks AS (SELECT a.customer_id, a.order_date, CAST(1 + coalesce(sum(b.n), 0) AS BIGINT) AS ranking
            FROM member_days a LEFT JOIN member_days b ON b.customer_id = a.customer_id AND b.order_date < a.order_date
            GROUP BY a.customer_id, a.order_date)
        SELECT s.customer_id, s.order_date, m.product_name, m.price, if(r.ranking IS NULL, 'N', 'Y') AS member, r.ranking
        FROM diner_sales s JOIN diner_menu m ON m.product_id = s.product_id
        LEFT JOIN ranks r ON r.customer_id = s.customer_id AND r.order_date = s.order_date""",
}
