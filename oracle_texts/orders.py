"""Pizza orders, deliveries, ingredients and ratings."""

from __future__ import annotations

from tallyspark.functions import dialect as D
from tallyspark.functions.exact import ratio_sql
from tallyspark.plans.orders import DELIVERY_RATE_CENTS_PER_KM, EXTRA_PRICE, NEW_PIZZA_ID, NEW_PIZZA_NAME, SIGNUP_EPOCH
from tallyspark.sources import dims

_O, _DL = "pizza_orders_clean", "pizza_deliveries_clean"
_DELIVERED = f"{_O} o JOIN {_DL} d ON d.order_id = o.order_id AND d.cancellation IS NULL"
_WAIT = D.seconds_between_sql("d.pickup_time", "o.order_time")
_PRICE = "CASE " + " ".join(f"WHEN o.pizza_id = {k} THEN {v}" for k, v in dims.PIZZA_PRICES.items()) + " END"
_SPEED = ratio_sql("CAST(d.distance * 10 AS BIGINT) * 6", "d.duration", 2)


def _id_list(c: str) -> str:
    return f"list_transform(string_split({c}, ','), lambda x: CAST(trim(x) AS BIGINT))"


# every order line with its lists of topping ids: recipe without exclusions, then extras
_LISTS = f"""lines AS (SELECT o.id, o.order_id, n.pizza_name, {_id_list('r.toppings')} AS recipe,
            coalesce({_id_list('o.exclusions')}, []) AS ex, coalesce({_id_list('o.extras')}, []) AS ad
        FROM {_O} o JOIN pizza_names n ON n.pizza_id = o.pizza_id LEFT JOIN pizza_recipes r ON r.pizza_id = o.pizza_id),
        used AS (SELECT id, order_id, pizza_name, list_concat(list_filter(recipe, lambda t: NOT list_contains(ex, t)), ad) AS ids FROM lines WHERE recipe IS NOT NULL),
        known AS (SELECT list(topping_id ORDER BY lower(topping_name), topping_name) AS ids, list(topping_name ORDER BY lower(topping_name), topping_name) AS names FROM pizza_toppings)"""
_VALIDATED = """validated AS (
        SELECT i.order_id, i.runner_id, i.customer_id, i.rating,
            CASE WHEN i.rating NOT BETWEEN 1 AND 5 THEN 'rating out of range'
                 WHEN k.order_id IS NULL THEN 'unknown key'
                 WHEN count(*) FILTER (WHERE i.rating BETWEEN 1 AND 5 AND k.order_id IS NOT NULL)
                      OVER (PARTITION BY i.order_id) > 1 THEN 'duplicate key' END AS reject_reason
        FROM pizza_ratings_incoming i LEFT JOIN pizza_delivered_keys k
          ON k.order_id = i.order_id AND k.runner_id = i.runner_id AND k.customer_id = i.customer_id)"""


def _top_listed(col: str) -> str:
    return f"""WITH c AS (SELECT unnest({_id_list(col)}) AS topping_id FROM {_O}),
            n AS (SELECT topping_name, count(*) AS uses FROM c JOIN pizza_toppings USING (topping_id) GROUP BY topping_name)
        SELECT arg_min(topping_name, (-uses, topping_name)) AS topping_name, max(uses) AS uses FROM n"""


def _names(ids: str) -> str:
    """Names of the listed ids that are known, as often as they come, in the order of names."""
    return f"list_concat([''], flatten(list_transform(range(1, len(known.ids) + 1), lambda i: list_transform(list_filter({ids}, lambda t: t = known.ids[i]), lambda t: known.names[i]))))[2:]"


SQL = {
    "pizza_recipes_mapped": f"""WITH r AS (SELECT pizza_id, unnest({_id_list('toppings')}) AS topping_id FROM pizza_recipes)
        SELECT pizza_id, pizza_name, topping_id, topping_name FROM r JOIN pizza_names USING (pizza_id) JOIN pizza_toppings USING (topping_id)
        WHERE EXISTS (SELECT 1 FROM {_O} o WHERE o.pizza_id = r.pizza_id)""",
    "pizza_orders_cleaned": f"SELECT * FROM {_O}",
    "pizza_deliveries_cleaned": f"SELECT * FROM {_DL}",
    "pizza_count": f"SELECT count(pizza_id) AS pizzas FROM {_O}",
    "pizza_unique_orders": f"SELECT count(*) AS unique_customer_orders FROM (SELECT order_id, customer_id FROM {_O} GROUP BY 1, 2) t",
    "pizza_successful_deliveries": f"SELECT runner_id, count(*) AS delivered FROM {_DL} WHERE cancellation IS NULL GROUP BY runner_id",
    "pizza_delivered_by_type": f"SELECT o.pizza_id, count(o.pizza_id) AS pizza_delivered FROM {_DELIVERED} GROUP BY o.pizza_id",
    "pizza_by_customer_type": f"""SELECT o.customer_id, pn.pizza_name, count(*) AS pizzas
        FROM {_DL} d JOIN {_O} o ON o.order_id = d.order_id JOIN pizza_names pn ON pn.pizza_id = o.pizza_id
        GROUP BY o.customer_id, pn.pizza_name""",
    "pizza_max_per_order": f"SELECT order_id, count(*) AS pizzas FROM {_O} GROUP BY order_id ORDER BY pizzas DESC, order_id LIMIT 1",
    "pizza_changes_by_customer": f"""SELECT o.customer_id,
        count(*) FILTER (WHERE exclusions IS NOT NULL OR extras IS NOT NULL) AS changes_count,
        count(*) FILTER (WHERE exclusions IS NULL AND extras IS NULL) AS no_changes
        FROM {_DELIVERED} GROUP BY o.customer_id""",
    "pizza_both_changes": f"SELECT count(*) AS pizzas FROM {_DELIVERED} WHERE exclusions IS NOT NULL AND extras IS NOT NULL",
    "pizza_volume_by_hour": f"""SELECT CAST(hour(o.order_time) AS BIGINT) AS hour_of_day, count(*) AS volume
        FROM {_DL} d JOIN {_O} o ON o.order_id = d.order_id GROUP BY 1""",
    "pizza_volume_by_weekday": f"""SELECT CAST(isodow(o.order_time) AS BIGINT) AS day_of_week, count(*) AS volume
        FROM {_DL} d JOIN {_O} o ON o.order_id = d.order_id GROUP BY 1""",
    "runner_signups_by_week": f"""SELECT CAST(datediff('day', DATE '{SIGNUP_EPOCH}', registration_date) // 7 + 1 AS BIGINT) AS week,
        count(*) AS runners FROM pizza_runners GROUP BY 1""",
    "runner_signups_by_iso_week": f"SELECT {D.iso_week_sql('registration_date')} AS week, count(*) AS runners FROM pizza_runners GROUP BY 1",
    "runner_pickup_minutes": f"""SELECT d.runner_id, {ratio_sql(f'sum({_WAIT})', f'count({_WAIT}) * 60', 4)} AS minutes
        FROM {_O} o JOIN {_DL} d ON d.order_id = o.order_id GROUP BY d.runner_id""",
    "order_prep_vs_size": f"""SELECT DISTINCT o.order_id, {ratio_sql(_WAIT, '60', 4)} AS minutes,
        count(o.pizza_id) OVER (PARTITION BY o.order_id) AS no_of_pizza FROM {_DELIVERED}""",
    "customer_avg_distance": f"""SELECT o.customer_id,
        {ratio_sql('sum(CAST(d.distance * 10 AS BIGINT))', 'count(d.distance) * 10', 2)} AS avg_distance
        FROM {_DL} d JOIN {_O} o ON o.order_id = d.order_id GROUP BY o.customer_id""",
    "delivery_time_range": f"""SELECT {ratio_sql(f'max({_WAIT}) - min({_WAIT})', '60', 4)} AS difference,
        max(d.duration) - min(d.duration) AS duration_difference FROM {_O} o JOIN {_DL} d ON d.order_id = o.order_id""",
    "runner_speed": f"""WITH s AS (SELECT o.order_id, d.runner_id, o.order_time, {_SPEED} AS order_speed
            FROM {_DL} d JOIN {_O} o ON o.order_id = d.order_id)
        SELECT order_id, order_speed,
            {ratio_sql('sum(CAST(order_speed * 100 AS BIGINT)) OVER (PARTITION BY runner_id)',
                       'count(order_speed) OVER (PARTITION BY runner_id) * 100', 4)} AS runner_average,
            CAST(hour(order_time) AS BIGINT) AS hour_of_day FROM s""",
    "runner_success_pct": f"""SELECT runner_id,
        {ratio_sql('count(order_id) - count(cancellation)', 'count(order_id)', 2, 100)} AS success_del_perc
        FROM {_DL} GROUP BY runner_id""",
    "ingredient_standard_list": f"""SELECT pizza_name, array_to_string({_names('ids')}, ', ') AS toppings
        FROM (SELECT pizza_id, {_id_list('toppings')} AS ids FROM pizza_recipes) r JOIN pizza_names USING (pizza_id),
            (SELECT list(topping_id ORDER BY lower(topping_name), topping_name) AS ids, list(topping_name ORDER BY lower(topping_name), topping_name) AS names FROM pizza_toppings) known
        WHERE pizza_id IN (SELECT pizza_id FROM {_O})""".replace("lambda t: t = known", "lambda t: t = known").replace("list_filter(ids,", "list_filter(r.ids,"),
    "ingredient_top_extra": _top_listed("extras"),
    "ingredient_top_exclusion": _top_listed("exclusions"),
    "order_item_text": f"""WITH {_LISTS}, t AS (SELECT id, order_id, pizza_name, array_to_string({_names('lines.ex')}, ', ') AS x, array_to_string({_names('lines.ad')}, ', ') AS y FROM lines, known)
        SELECT id, order_id, pizza_name || coalesce(' - Exclude ' || nullif(x, ''), '') || coalesce(' - Extra ' || nullif(y, ''), '') AS order_item FROM t""",
    "ingredient_list_text": f"""WITH {_LISTS}, c AS (SELECT id, pizza_name, list_filter(list_transform(range(1, len(known.ids) + 1), lambda i:
                {{'name': known.names[i], 'n': len(list_filter(used.ids, lambda t: t = known.ids[i]))}}), lambda s: s.n > 0) AS items FROM used, known)
        SELECT id, pizza_name || ': ' || array_to_string(list_transform(items, lambda s: if(s.n > 1, s.n || 'x ', '') || s.name), ', ') AS ingredients_text FROM c""",
    "ingredient_usage": f"""WITH {_LISTS}, t AS (SELECT unnest(ids) AS topping_id FROM used SEMI JOIN (SELECT order_id FROM {_DL} WHERE cancellation IS NULL) d USING (order_id))
        SELECT topping_id, topping_name, count(*) AS uses FROM t JOIN pizza_toppings USING (topping_id) GROUP BY ALL""",
    "revenue_fixed": f"SELECT CAST(sum({_PRICE}) AS BIGINT) AS total_sale FROM {_DELIVERED}",
    "revenue_with_extras": f"""SELECT CAST(sum({_PRICE} + COALESCE(len(string_split(extras, ',')), 0) * {EXTRA_PRICE}) AS BIGINT)
        AS total_sale FROM {_DELIVERED}""",
    "delivered_order_keys": "SELECT * FROM pizza_delivered_keys",
    "rating_validation": f"WITH {_VALIDATED} SELECT * FROM validated",
    "rating_duplicate_keys": """SELECT order_id, count(*) AS rows FROM pizza_ratings_incoming GROUP BY order_id HAVING count(*) > 1""",
    "rating_range_violations": """SELECT * FROM pizza_ratings_incoming WHERE rating NOT BETWEEN 1 AND 5 OR rating IS NULL""",
    "delivery_fact": f"""WITH {_VALIDATED},
        po AS (SELECT order_id, count(pizza_id) AS number_of_pizza, max(order_time) AS order_time FROM {_O} GROUP BY order_id)
        SELECT v.customer_id, v.order_id, v.runner_id, v.rating, po.order_time, d.pickup_time,
            {D.time_of_day_sql('po.order_time')} AS order_time_of_day, {D.time_of_day_sql('d.pickup_time')} AS pickup_time_of_day,
            {ratio_sql(D.seconds_between_sql('d.pickup_time', 'po.order_time'), '60', 4)} AS preparation_minutes,
            d.duration, {_SPEED} AS average_speed, po.number_of_pizza
        FROM validated v JOIN {_DL} d ON d.order_id = v.order_id JOIN po ON po.order_id = v.order_id
        WHERE v.reject_reason IS NULL""",
    "profit_after_delivery": f"""WITH per AS (SELECT o.order_id, sum({_PRICE}) AS rev, max(CAST(d.distance * 10 AS BIGINT)) AS tenths
            FROM {_DELIVERED} GROUP BY o.order_id)
        SELECT {ratio_sql(f'sum(rev * 1000 - tenths * {DELIVERY_RATE_CENTS_PER_KM})', '1000', 2)} AS profit FROM per""",
    "recipe_append_all": f"""SELECT pizza_id, toppings FROM pizza_recipes
        UNION ALL
        SELECT CAST({NEW_PIZZA_ID} AS BIGINT), array_to_string(list_sort(list_distinct(flatten(list({_id_list('extras')})))), ', ')
        FROM {_O} WHERE extras IS NOT NULL""",
    "menu_with_new_pizza": f"""SELECT pizza_id, pizza_name, toppings FROM pizza_names JOIN pizza_recipes USING (pizza_id)
        WHERE pizza_id IN (SELECT pizza_id FROM {_O})
        UNION ALL
        SELECT CAST({NEW_PIZZA_ID} AS BIGINT), '{NEW_PIZZA_NAME}', array_to_string(list_sort(list(topping_id)), ', ') FROM pizza_toppings""",
    "pizza_changes_unnested": f"""WITH {_LISTS}
        SELECT id, order_id, pizza_name, ex[k] AS exclusion, ad[k] AS extra
        FROM (SELECT *, unnest(range(1, greatest(len(ex), len(ad)) + 1)) AS k FROM lines) t""",
    "ratings_kept": f"WITH {_VALIDATED} SELECT order_id, runner_id, customer_id, rating FROM validated WHERE reject_reason IS NULL",
}
