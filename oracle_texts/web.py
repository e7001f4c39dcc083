"""Clickstream: visits, funnels, campaigns."""

from __future__ import annotations

from tallyspark.functions.exact import ratio_sql
from tallyspark.plans.web import AD_CLICK, AD_IMPRESSION, ADD_TO_CART, PAGE_VIEW, PURCHASE
from tallyspark.sources.dims import CHECKOUT_PAGE

_E, _P, _I = "click_events", "click_page_hierarchy", "click_event_identifier"

# one row per visit and page: was it seen, put in the cart, and did the visit end in a purchase
_SEEN = f"""seen AS (SELECT visit_id, page_id, coalesce(bool_or(event_type = {PAGE_VIEW}), false) AS viewed,
            coalesce(bool_or(event_type = {ADD_TO_CART}), false) AS carted,
            coalesce(bool_or(bool_or(event_type = {PURCHASE})) OVER (PARTITION BY visit_id), false) AS bought
        FROM {_E} GROUP BY visit_id, page_id)"""


def _counts(by: str) -> str:
    return f"""SELECT {by}, count(*) FILTER (WHERE viewed) AS product_views, count(*) FILTER (WHERE carted) AS product_added_to_cart,
            count(*) FILTER (WHERE carted AND NOT bought) AS total_abandoned_carts, count(*) FILTER (WHERE carted AND bought) AS total_purchases
        FROM seen JOIN {_P} USING (page_id) WHERE product_id IS NOT NULL GROUP BY {by}"""


_FUNNEL = f"{_SEEN}, funnel AS ({_counts('page_name')})"


def _mean_ratio(num: str, den: str, out: str) -> str:
    return f"""WITH {_FUNNEL}, r AS (SELECT {ratio_sql(num, den, 10, 100)} AS r FROM funnel)
        SELECT {ratio_sql('CAST(sum(r) * 10000000000 AS HUGEINT)', 'count(r) * 10000000000', 2)} AS {out} FROM r"""


def _first(order: str) -> str:
    return f"arg_min(page_name, ({order}, page_name))"


SQL = {
    "web_users": "SELECT user_id FROM click_users GROUP BY user_id",
    "web_cookies_per_user": f"SELECT {ratio_sql('count(cookie_id)', 'count(DISTINCT user_id)', 2)} AS average_cookie_per_user FROM click_users",
    "web_visits_by_month": f"""SELECT CAST(month AS BIGINT) AS month, count(*) AS visit_count
        FROM (SELECT DISTINCT visit_id, month(event_time) AS month FROM {_E} WHERE cookie_id IN (SELECT cookie_id FROM click_users)) v
        GROUP BY month""",
    "web_events_by_type": f"""SELECT event_name, n AS no_of_events FROM {_I}
        JOIN (SELECT event_type, count(*) AS n FROM {_E} GROUP BY event_type) c USING (event_type)""",
    "web_purchase_visit_pct": f"""SELECT {ratio_sql(f'count(DISTINCT visit_id) FILTER (WHERE event_type = {PURCHASE})', 'count(DISTINCT visit_id)', 2, 100)}
        AS purchase_visit_perc FROM {_E}""",
    "web_checkout_no_purchase_pct": f"""WITH v AS (SELECT visit_id, bool_or(page_id = {CHECKOUT_PAGE}) AS reached, bool_or(event_type = {PURCHASE}) AS bought,
            len(list_distinct(list(event_type) FILTER (WHERE page_id = {CHECKOUT_PAGE} AND event_type IN (SELECT event_type FROM {_I})))) AS kinds
            FROM {_E} GROUP BY visit_id)
        SELECT {ratio_sql('coalesce(sum(kinds) FILTER (WHERE NOT bought), 0)', 'count(*) FILTER (WHERE reached)', 2, 100)} AS purchase_visit_perc FROM v""",
    "web_top_pages": f"""SELECT page_name, no_of_page_view FROM {_P}
        JOIN (SELECT page_id, count(*) FILTER (WHERE event_type = {PAGE_VIEW}) AS no_of_page_view FROM {_E} GROUP BY page_id) c USING (page_id)
        WHERE no_of_page_view > 0 ORDER BY -no_of_page_view, page_name LIMIT 3""",
    "web_views_carts_by_category": f"""SELECT product_category, count(*) FILTER (WHERE event_type = {PAGE_VIEW}) AS number_of_page_views,
            count(*) FILTER (WHERE event_type = {ADD_TO_CART}) AS number_of_add_to_cart_events
        FROM {_P} JOIN {_E} USING (page_id) WHERE product_id IS NOT NULL GROUP BY product_category""",
    "web_top_products": f"""WITH v AS (SELECT unnest(list(page_id) FILTER (WHERE event_type = {ADD_TO_CART})) AS page_id
            FROM {_E} GROUP BY visit_id HAVING bool_or(event_type = {PURCHASE}))
        SELECT page_name, count(*) AS number_of_purchases FROM v JOIN {_P} USING (page_id) WHERE product_id > 0
        GROUP BY page_name ORDER BY -count(*), page_name LIMIT 3""",
    "web_product_funnel": f"WITH {_FUNNEL} FROM funnel",
    "web_category_funnel": f"WITH {_SEEN} {_counts('product_category')}",
    "web_product_leaders": f"""WITH {_FUNNEL}, best AS (SELECT [{_first('-product_views')}, {_first('-product_added_to_cart')}, {_first('-total_purchases')}] AS names FROM funnel)
        SELECT page_name AS product, product_views, product_added_to_cart, total_purchases FROM funnel, best WHERE list_contains(names, page_name)""",
    "web_most_abandoned": f"WITH {_FUNNEL} SELECT {_first('-total_abandoned_carts')} AS product, max(total_abandoned_carts) AS total_abandoned_carts FROM funnel",
    "web_best_view_to_purchase": f"""WITH {_FUNNEL}, r AS (SELECT page_name, {ratio_sql('total_purchases', 'product_views', 12, 100)} AS k,
            {ratio_sql('total_purchases', 'product_views', 2, 100)} AS perc FROM funnel WHERE product_views > 0)
        SELECT {_first('-k')} AS product, arg_min(perc, (-k, page_name)) AS view_to_purchase_perc FROM r""",
    "web_view_to_cart_rate": _mean_ratio("product_added_to_cart", "product_views", "view_to_cart_add_perc"),
    "web_cart_to_purchase_rate": _mean_ratio("total_purchases", "product_added_to_cart", "cart_to_purchase_perc"),
    "web_visit_campaigns": f"""SELECT u.user_id, v.visit_id, v.visit_start_time, v.page_views, v.cart_adds, v.purchase, c.campaign_name, v.impression, v.click
        FROM (SELECT visit_id, any_value(cookie_id) AS cookie_id, min(event_time) AS visit_start_time,
                count(*) FILTER (WHERE event_type = {PAGE_VIEW}) AS page_views, count(*) FILTER (WHERE event_type = {ADD_TO_CART}) AS cart_adds,
                CAST(coalesce(bool_or(event_type = {PURCHASE}), false) AS BIGINT) AS purchase,
                count(*) FILTER (WHERE event_type = {AD_IMPRESSION}) AS impression, count(*) FILTER (WHERE event_type = {AD_CLICK}) AS click
              FROM {_E} GROUP BY visit_id) v
        JOIN click_users u USING (cookie_id)
        LEFT JOIN click_campaigns c ON v.visit_start_time >= c.start_date AND v.visit_start_time <= c.end_date""",
    "web_abandoned_cart_adds": f"""SELECT page_id, count(*) AS abandoned FROM {_E}
        WHERE event_type = {ADD_TO_CART} AND visit_id NOT IN (SELECT visit_id FROM {_E} WHERE event_type = {PURCHASE}) GROUP BY page_id""",
    "web_not_in_lists": f"""WITH carts AS (SELECT visit_id FROM {_E} WHERE event_type = {ADD_TO_CART}),
            bought AS (SELECT visit_id, page_id FROM {_E} WHERE event_type = {PURCHASE})
        SELECT 'plain_list' AS list, (SELECT count(*) FROM carts WHERE visit_id NOT IN (SELECT visit_id FROM bought)) AS kept
        UNION ALL SELECT 'list_with_null', (SELECT count(*) FROM carts WHERE visit_id NOT IN
            (SELECT CASE WHEN page_id <> {CHECKOUT_PAGE} THEN visit_id END FROM bought))
        UNION ALL SELECT 'empty_list', (SELECT count(*) FROM carts WHERE visit_id NOT IN (SELECT visit_id FROM bought WHERE false))""",
}
SQL["web_visits_in_order"] = f"SELECT row_number() OVER (ORDER BY user_id, visit_start_time, visit_id) AS position, v.* FROM ({SQL['web_visit_campaigns']}) v"
