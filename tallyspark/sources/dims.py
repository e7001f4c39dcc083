"""Small fixed dimensions.

The values below are fixed: they must equal the case studies' own lookup rows for the
analytics to mean the same thing (plan prices, pizza recipes and toppings, event names).
They are inline ``VALUES``, whose size Spark knows, so it broadcasts them without a hint.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------
PIZZA_NAMES = [(1, "Meatlovers"), (2, "Vegetarian")]
PIZZA_RECIPES = [(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")]
PIZZA_TOPPINGS = [
    (1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"), (6, "Mushrooms"),
    (7, "Onions"), (8, "Pepperoni"), (9, "Peppers"), (10, "Salami"), (11, "Tomatoes"), (12, "Tomato Sauce"),
]
PIZZA_PRICES = {1: 12, 2: 10}  # fixed price per pizza_id
PLANS = [
    (0, "trial", Decimal("0.00")), (1, "basic monthly", Decimal("9.90")), (2, "pro monthly", Decimal("19.90")),
    (3, "pro annual", Decimal("199.00")), (4, "churn", None),
]
EVENT_NAMES = [(1, "Page View"), (2, "Add to Cart"), (3, "Purchase"), (4, "Ad Impression"), (5, "Ad Click")]
# event_type text of the driver's events table → event id above
EVENT_TYPE_IDS = [("view", 1), ("click", 2), ("purchase", 3), ("signup", 4), ("error", 5)]
AGE_BANDS = [("1", "Young Adults"), ("2", "Middle Aged"), ("3", "Retirees"), ("4", "Retirees")]
DEMOGRAPHICS = [("C", "Couples"), ("F", "Families")]
# ------------------------------------------------------------------------------------

# Our own choices for the synthetic clickstream dimensions (not from the case studies).
CHECKOUT_PAGE = 12
CAMPAIGNS = [
    ("Campaign A", "2024-01-03 00:00:00", "2024-01-09 23:59:59"),
    ("Campaign B", "2024-01-12 00:00:00", "2024-01-18 23:59:59"),
    ("Campaign C", "2024-01-20 00:00:00", "2024-01-22 23:59:59"),
]


def _values_sql(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)  # ints and Decimals print as SQL numeric literals
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def pizza_names(spark: SparkSession) -> DataFrame:
    return spark.sql(SQL["pizza_names"])


def pizza_recipes(spark: SparkSession) -> DataFrame:
    return spark.sql(SQL["pizza_recipes"])


def pizza_toppings(spark: SparkSession) -> DataFrame:
    return spark.sql(SQL["pizza_toppings"])


def plans(spark: SparkSession) -> DataFrame:
    return spark.sql(SQL["plan_catalog"])


def event_identifier(spark: SparkSession) -> DataFrame:
    return spark.sql(SQL["click_event_identifier"])


def page_hierarchy(events: DataFrame) -> DataFrame:
    """The pages that ``events`` (``page_id``) name; every tenth page, the home page (1), checkout (12)
    and confirmation (13) carry no product."""
    pid = F.col("page_id")
    no_product = (pid % 10 == 0) | pid.isin(1, CHECKOUT_PAGE, 13)
    return events.select("page_id").where(pid.isNotNull()).distinct().select(
        "page_id",
        F.when(pid == 1, "Home Page").when(pid == CHECKOUT_PAGE, "Checkout").when(pid == 13, "Confirmation")
        .otherwise(F.concat(F.lit("page_"), pid.cast("string"))).alias("page_name"),
        F.when(~no_product, F.concat(F.lit("cat_"), (pid % 3).cast("string"))).alias("product_category"),
        F.when(~no_product, pid).alias("product_id"),
    )


def campaigns(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(CAMPAIGNS, "campaign_name string, start_date string, end_date string")
    return df.select(
        "campaign_name",
        F.to_timestamp_ntz("start_date").alias("start_date"),
        F.to_timestamp_ntz("end_date").alias("end_date"),
    )


SQL = {
    "pizza_names": "SELECT CAST(pizza_id AS BIGINT) AS pizza_id, pizza_name FROM "
                   + _values_sql(PIZZA_NAMES, ["pizza_id", "pizza_name"]),
    "pizza_recipes": "SELECT CAST(pizza_id AS BIGINT) AS pizza_id, toppings FROM "
                     + _values_sql(PIZZA_RECIPES, ["pizza_id", "toppings"]),
    "pizza_toppings": "SELECT CAST(topping_id AS BIGINT) AS topping_id, topping_name FROM "
                      + _values_sql(PIZZA_TOPPINGS, ["topping_id", "topping_name"]),
    "plan_catalog": "SELECT CAST(plan_id AS BIGINT) AS plan_id, plan_name, CAST(price AS DECIMAL(5,2)) AS price FROM "
                    + _values_sql(PLANS, ["plan_id", "plan_name", "price"]),
    "click_event_identifier": "SELECT CAST(event_type AS BIGINT) AS event_type, event_name FROM "
                              + _values_sql(EVENT_NAMES, ["event_type", "event_name"]),
    "click_page_hierarchy": f"""SELECT page_id,
        CASE WHEN page_id = 1 THEN 'Home Page' WHEN page_id = {CHECKOUT_PAGE} THEN 'Checkout'
             WHEN page_id = 13 THEN 'Confirmation' ELSE 'page_' || CAST(page_id AS VARCHAR) END AS page_name,
        CASE WHEN NOT (page_id % 10 = 0 OR page_id IN (1, {CHECKOUT_PAGE}, 13))
             THEN 'cat_' || CAST(page_id % 3 AS VARCHAR) END AS product_category,
        CASE WHEN NOT (page_id % 10 = 0 OR page_id IN (1, {CHECKOUT_PAGE}, 13)) THEN page_id END AS product_id
        FROM (SELECT DISTINCT page_id FROM click_events WHERE page_id IS NOT NULL) p""",
    "click_campaigns": "SELECT campaign_name, CAST(start_date AS TIMESTAMP) AS start_date, "
                       "CAST(end_date AS TIMESTAMP) AS end_date FROM "
                       + _values_sql(CAMPAIGNS, ["campaign_name", "start_date", "end_date"]),
}
