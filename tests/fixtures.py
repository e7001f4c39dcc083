"""Hand-checkable case-study inputs (fixed values: the case studies' own sample rows).

Used only by unit tests, with the goldens of FIXTURES.md.
"""

import datetime as dt

# --- fixed values: diner sample --------------------------------------------------
SALES = [
    ("A", "2021-01-01", 1), ("A", "2021-01-01", 2), ("A", "2021-01-07", 2), ("A", "2021-01-10", 3),
    ("A", "2021-01-11", 3), ("A", "2021-01-11", 3), ("B", "2021-01-01", 2), ("B", "2021-01-02", 2),
    ("B", "2021-01-04", 1), ("B", "2021-01-11", 1), ("B", "2021-01-16", 3), ("B", "2021-02-01", 3),
    ("C", "2021-01-01", 3), ("C", "2021-01-01", 3), ("C", "2021-01-07", 3),
]
MENU = [(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)]
MEMBERS = [("A", "2021-01-07"), ("B", "2021-01-09")]

# --- fixed values: pizza sample ----------------------------------------------------
RUNNERS = [(1, "2021-01-01"), (2, "2021-01-03"), (3, "2021-01-08"), (4, "2021-01-15")]
CUSTOMER_ORDERS = [
    (1, 101, 1, "", "", "2020-01-01 18:05:02"),
    (2, 101, 1, "", "", "2020-01-01 19:00:52"),
    (3, 102, 1, "", "", "2020-01-02 23:51:23"),
    (3, 102, 2, "", None, "2020-01-02 23:51:23"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 2, "4", "", "2020-01-04 13:23:46"),
    (5, 104, 1, "null", "1", "2020-01-08 21:00:29"),
    (6, 101, 2, "null", "null", "2020-01-08 21:03:13"),
    (7, 105, 2, "null", "1", "2020-01-08 21:20:29"),
    (8, 102, 1, "null", "null", "2020-01-09 23:54:33"),
    (9, 103, 1, "4", "1, 5", "2020-01-10 11:22:59"),
    (10, 104, 1, "null", "null", "2020-01-11 18:34:49"),
    (10, 104, 1, "2, 6", "1, 4", "2020-01-11 18:34:49"),
]
RUNNER_ORDERS = [
    (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
    (2, 1, "2020-01-01 19:10:54", "20km", "27 minutes", ""),
    (3, 1, "2020-01-03 00:12:37", "13.4km", "20 mins", None),
    (4, 2, "2020-01-04 13:53:03", "23.4", "40", None),
    (5, 3, "2020-01-08 21:10:57", "10", "15", None),
    (6, 3, "null", "null", "null", "Restaurant Cancellation"),
    (7, 2, "2020-01-08 21:30:45", "25km", "25mins", "null"),
    (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", "null"),
    (9, 2, "null", "null", "null", "Customer Cancellation"),
    (10, 1, "2020-01-11 18:50:20", "10km", "10minutes", "null"),
]
# ------------------------------------------------------------------------------------


def d(s):
    return dt.date.fromisoformat(s)


def diner_frames(spark):
    sales = spark.createDataFrame([(c, d(o), p) for c, o, p in SALES], "customer_id string, order_date date, product_id long")
    menu = spark.createDataFrame(MENU, "product_id long, product_name string, price long")
    members = spark.createDataFrame([(c, d(j)) for c, j in MEMBERS], "customer_id string, join_date date")
    return sales, menu, members


def pizza_frames(spark):
    from tallyspark.plans import orders as P
    raw_o = spark.createDataFrame(
        [(str(i + 1), o, c, p, ex, ad, dt.datetime.fromisoformat(t))
         for i, (o, c, p, ex, ad, t) in enumerate(CUSTOMER_ORDERS)],
        "row_key string, order_id long, customer_id long, pizza_id long, exclusions string, extras string, "
        "order_time timestamp_ntz")
    raw_d = spark.createDataFrame(RUNNER_ORDERS, "order_id long, runner_id long, pickup_time string, distance string, "
                                                 "duration string, cancellation string")
    runners = spark.createDataFrame([(r, d(x)) for r, x in RUNNERS], "runner_id long, registration_date date")
    return P.clean_orders(raw_o), P.clean_deliveries(raw_d), runners
