"""Case-study views over the driver's tables.

Each view exists twice with the same meaning: a Spark builder taking :class:`Tables`
and DuckDB text in :data:`SQL` (used only by the correctness oracle). The mapping from
the TPC-H-like tables to each case study's schema is our own choice; every view reads
whole tables, so its work grows with the data.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.exact import int_div
from tallyspark.operators.prefix import scan
from tallyspark.sources import dims
from tallyspark.sources.tables import Tables

OPEN_END = "9999-12-31"
MEMBER_EPOCH = "1998-01-01"


def _date(c: str):
    return F.to_date(F.col(c))


def _wall_clock_text(ts):
    """``yyyy-MM-dd HH:mm:ss`` of a timestamp_ntz, built from its parts so no session time
    zone is involved (formatting converts through the zone and shifts DST-gap times)."""
    def two(c):
        return F.lpad(c.cast("string"), 2, "0")
    return F.concat(F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit("-"), two(F.month(ts)), F.lit("-"),
                    two(F.dayofmonth(ts)), F.lit(" "), two(F.hour(ts)), F.lit(":"), two(F.minute(ts)), F.lit(":"),
                    two(F.second(ts)))


def _key(*cols):
    return F.concat_ws("-", *[F.col(c).cast("string") for c in cols])


# ---------------------------------------------------------------- D1 purchases & loyalty
def diner_sales(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("customer_id"), _date("o_orderdate").alias("order_date"))
    li = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("product_id"))
    return li.join(o, li.l_orderkey == o.o_orderkey).select("customer_id", "order_date", "product_id")


def diner_menu(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.floor("p_retailprice").cast("bigint").alias("price"),
    )


def diner_members(t: Tables) -> DataFrame:
    """Customers in credit are members; the join date spreads over one year."""
    return t.customer.where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("customer_id"),
        F.date_add(F.lit(MEMBER_EPOCH).cast("date"), (F.col("c_custkey") % 365).cast("int")).alias("join_date"),
    )


# ---------------------------------------------------------------- D2 pizza orders (raw, dirty)
def _csv(*parts):
    return F.concat_ws(", ", *[p.cast("string") for p in parts])


def pizza_customer_orders(t: Tables) -> DataFrame:
    """One row per pizza (lineitem); lists packed in text, with '', 'null' and NULL mixed in."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    # Lines sharing these four keys give identical pizza rows (copies); number the copies
    # so every row has its own id. Counting first lets partial aggregation fold copies.
    copies = t.lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    li = copies.select(*keys, F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))).alias("copy"))
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    pk, sk, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    excl_a, excl_b = sk % 12 + 1, ln + 3
    extra_a, extra_b = pk % 12 + 1, ln % 12 + 1
    exclusions = (F.when(pk % 7 == 1, F.lit("")).when(pk % 7 == 2, F.lit("null"))
                  .when(pk % 7 == 4, excl_a.cast("string")).when(pk % 7 == 5, _csv(excl_a, excl_b))
                  .when(pk % 7 == 6, F.lit("")))
    extras = (F.when(sk % 7 == 1, F.lit("null")).when(sk % 7 == 2, F.lit(""))
              .when(sk % 7 == 4, extra_a.cast("string")).when(sk % 7 == 5, _csv(extra_a, extra_b)))
    return j.select(
        _key(*keys, "copy").alias("row_key"),
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (pk % 2 + 1).alias("pizza_id"),
        exclusions.alias("exclusions"),
        extras.alias("extras"),
        (F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))).alias("order_time"),
    )


def pizza_runner_orders(t: Tables) -> DataFrame:
    """One row per order; pickup/distance/duration as text with units, 'null' when cancelled."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    k = F.col("o_orderkey")
    cancelled = F.col("o_orderstatus") == "F"
    pickup = _wall_clock_text(F.col("o_orderdate") + F.make_dt_interval(mins=(k % 1440 + k % 37 + 5).cast("int")))
    dist = F.concat((k % 40 + 1).cast("string"), F.lit("."), (k % 10).cast("string"),
                    F.when(k % 3 == 0, "km").when(k % 3 == 1, " km").otherwise(""))
    dur = F.concat((k % 35 + 10).cast("string"),
                   F.when(k % 4 == 0, "mins").when(k % 4 == 1, " minutes").when(k % 4 == 2, " minute").otherwise(""))
    cancel = (F.when(cancelled, F.when(k % 2 == 0, "Restaurant Cancellation").otherwise("Customer Cancellation"))
              .when(k % 3 == 1, F.lit("")).when(k % 3 == 2, F.lit("null")))
    return o.select(
        k.alias("order_id"),
        (F.col("o_custkey") % 10 + 1).alias("runner_id"),
        F.when(cancelled, "null").otherwise(pickup).alias("pickup_time"),
        F.when(cancelled, "null").otherwise(dist).alias("distance"),
        F.when(cancelled, "null").otherwise(dur).alias("duration"),
        cancel.alias("cancellation"),
    )


def pizza_runners(t: Tables) -> DataFrame:
    """Suppliers double as runners, registering over the first three weeks of 1998."""
    return t.supplier.select(
        F.col("s_suppkey").alias("runner_id"),
        F.date_add(F.lit(MEMBER_EPOCH).cast("date"), (F.col("s_suppkey") % 21).cast("int")).alias("registration_date"),
    )


# ---------------------------------------------------------------- D3 subscriptions
def plan_events(t: Tables) -> DataFrame:
    """Each order is a plan event; a customer's first order is the trial (plan 0), the
    others pick plan 1..4 (4 = churn) from the order key. ``event_key`` breaks date ties."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    first = o.groupBy("o_custkey").agg(F.min(F.struct("o_orderdate", "o_orderkey")).getField("o_orderkey").alias("first_key"))
    j = o.join(first, "o_custkey")
    return j.select(
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderkey") == F.col("first_key"), F.lit(0)).otherwise(F.col("o_orderkey") % 4 + 1)
        .cast("bigint").alias("plan_id"),
        _date("o_orderdate").alias("start_date"),
        F.col("o_orderkey").alias("event_key"),
    )


# ---------------------------------------------------------------- D4 nodes & transactions
def bank_nodes(t: Tables) -> DataFrame:
    """Each order re-allocates its customer to node ``orderkey % 5 + 1``, valid until the
    day before the customer's next order; the last allocation is open (9999-12-31)."""
    o = t.orders.select("o_orderkey", "o_custkey", _date("o_orderdate").alias("start_date"))
    o = scan(o, ["o_custkey"], ["start_date", "o_orderkey"], nxt=["start_date"])
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_regionkey")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    start = F.col("start_date")
    return j.select(
        F.col("o_custkey").alias("customer_id"),
        (F.col("n_regionkey") + 1).cast("bigint").alias("region_id"),
        (F.col("o_orderkey") % 5 + 1).alias("node_id"),
        start.alias("start_date"),
        F.coalesce(F.greatest(F.date_sub("next_start_date", 1), start), F.lit(OPEN_END).cast("date")).alias("end_date"),
    )


def bank_txns(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        _date("o_orderdate").alias("txn_date"),
        F.when(F.col("o_orderstatus") == "O", "deposit").when(F.col("o_orderstatus") == "F", "withdrawal")
        .otherwise("purchase").alias("txn_type"),
        F.floor("o_totalprice").cast("bigint").alias("txn_amount"),
    )


# ---------------------------------------------------------------- D5 weekly retail
def weekly_sales_raw(t: Tables) -> DataFrame:
    """Weekly sales by region × platform × segment × customer type, dates as d/M/yy text."""
    li = t.lineitem.select("l_orderkey", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    # the small tables first, along orders; the lines meet the result once
    placed = (o.join(c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")),
                     F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_custkey", "c_mktsegment", "r_name"))
    j = li.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    ck = F.col("c_custkey")
    segment = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("null")).otherwise(
        F.concat(F.when(ck % 2 == 0, "C").otherwise("F"), (ck % 4 + 1).cast("string")))
    keyed = j.select(
        F.date_sub(F.to_date("l_shipdate"), F.weekday(F.to_date("l_shipdate"))).alias("week_start"),  # Monday
        F.col("r_name").alias("region"),
        F.when(F.col("l_linestatus") == "O", "Retail").otherwise("Shopify").alias("platform"),
        segment.alias("segment"),
        F.when(F.col("l_returnflag") == "R", "New").when(F.col("l_returnflag") == "A", "Existing")
        .otherwise("Guest").alias("customer_type"),
        F.floor("l_extendedprice").cast("bigint").alias("amount"),
    )
    # group on the typed week start; the d/M/yy text is formatted once per output row
    weekly = keyed.groupBy("week_start", "region", "platform", "segment", "customer_type").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount").cast("bigint").alias("sales"))
    dmy = F.concat_ws("/", F.dayofmonth("week_start").cast("string"), F.month("week_start").cast("string"),
                      F.lpad((F.year("week_start") % 100).cast("string"), 2, "0"))
    return weekly.select(dmy.alias("week_date"), "region", "platform", "segment",
                         "customer_type", "transactions", "sales")


# ---------------------------------------------------------------- D6 clickstream
def click_events(t: Tables) -> DataFrame:
    """A visit is one user's events of one day; the page is the ``k`` of ``props``."""
    e = t.events
    ids = F.create_map(*[x for pair in dims.EVENT_TYPE_IDS for x in (F.lit(pair[0]), F.lit(pair[1]))])
    return e.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("visit_id"),
        F.col("user_id").alias("cookie_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("page_id"),
        ids[F.col("event_type")].cast("bigint").alias("event_type"),
        F.col("ts").alias("event_time"),
    )


def click_users(t: Tables) -> DataFrame:
    """Every events.user_id is a cookie; three consecutive cookies belong to one user."""
    cookies = t.events.select(F.col("user_id").alias("cookie_id")).distinct()
    return cookies.select(int_div("cookie_id", F.lit(3)).alias("user_id"), "cookie_id")


# ---------------------------------------------------------------- shared (materialised) views
SHARED_VIEWS = ("diner_sales", "plan_events", "bank_nodes", "click_events", "click_users")


def shared_view(t: Tables, name: str) -> DataFrame:
    """``name``'s view, materialised once and reused by every analytic reading it."""
    return t.view(name, lambda: globals()[name](t))


# ---------------------------------------------------------------- DuckDB text (oracle only)
SQL: dict[str, str] = {
    "diner_sales": """SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date,
        l.l_partkey AS product_id FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "diner_menu": """SELECT p_partkey AS product_id, p_name AS product_name,
        CAST(floor(p_retailprice) AS BIGINT) AS price FROM part""",
    "diner_members": f"""SELECT c_custkey AS customer_id,
        CAST(DATE '{MEMBER_EPOCH}' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS join_date
        FROM customer WHERE c_acctbal >= 0""",
    "pizza_customer_orders": """SELECT
        CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-' ||
        CAST(l.l_partkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) || '-' ||
        CAST(row_number() OVER (PARTITION BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS VARCHAR) AS row_key,
        l.l_orderkey AS order_id, o.o_custkey AS customer_id, l.l_partkey % 2 + 1 AS pizza_id,
        CASE l.l_partkey % 7 WHEN 1 THEN '' WHEN 2 THEN 'null'
             WHEN 4 THEN CAST(l.l_suppkey % 12 + 1 AS VARCHAR)
             WHEN 5 THEN CAST(l.l_suppkey % 12 + 1 AS VARCHAR) || ', ' || CAST(l.l_linenumber + 3 AS VARCHAR)
             WHEN 6 THEN '' END AS exclusions,
        CASE l.l_suppkey % 7 WHEN 1 THEN 'null' WHEN 2 THEN ''
             WHEN 4 THEN CAST(l.l_partkey % 12 + 1 AS VARCHAR)
             WHEN 5 THEN CAST(l.l_partkey % 12 + 1 AS VARCHAR) || ', ' || CAST(l.l_linenumber % 12 + 1 AS VARCHAR)
             END AS extras,
        o.o_orderdate + to_minutes(CAST(o.o_orderkey % 1440 AS BIGINT)) AS order_time
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "pizza_runner_orders": """SELECT o_orderkey AS order_id, o_custkey % 10 + 1 AS runner_id,
        CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE strftime(o_orderdate +
             to_minutes(CAST(o_orderkey % 1440 + o_orderkey % 37 + 5 AS BIGINT)), '%Y-%m-%d %H:%M:%S') END AS pickup_time,
        CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE CAST(o_orderkey % 40 + 1 AS VARCHAR) || '.' ||
             CAST(o_orderkey % 10 AS VARCHAR) ||
             CASE o_orderkey % 3 WHEN 0 THEN 'km' WHEN 1 THEN ' km' ELSE '' END END AS distance,
        CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE CAST(o_orderkey % 35 + 10 AS VARCHAR) ||
             CASE o_orderkey % 4 WHEN 0 THEN 'mins' WHEN 1 THEN ' minutes' WHEN 2 THEN ' minute' ELSE '' END
             END AS duration,
        CASE WHEN o_orderstatus = 'F' THEN
                  CASE WHEN o_orderkey % 2 = 0 THEN 'Restaurant Cancellation' ELSE 'Customer Cancellation' END
             WHEN o_orderkey % 3 = 1 THEN '' WHEN o_orderkey % 3 = 2 THEN 'null' END AS cancellation
        FROM orders""",
    "pizza_runners": f"""SELECT s_suppkey AS runner_id,
        CAST(DATE '{MEMBER_EPOCH}' + CAST(s_suppkey % 21 AS INTEGER) AS DATE) AS registration_date FROM supplier""",
    "plan_events": """SELECT o.o_custkey AS customer_id,
        CAST(CASE WHEN o.o_orderkey = f.first_key THEN 0 ELSE o.o_orderkey % 4 + 1 END AS BIGINT) AS plan_id,
        CAST(o.o_orderdate AS DATE) AS start_date, o.o_orderkey AS event_key
        FROM orders o JOIN (SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_key
                            FROM orders GROUP BY o_custkey) f ON f.o_custkey = o.o_custkey""",
    "bank_nodes": f"""SELECT o.o_custkey AS customer_id, CAST(n.n_regionkey + 1 AS BIGINT) AS region_id,
        o.o_orderkey % 5 + 1 AS node_id, CAST(o.o_orderdate AS DATE) AS start_date,
        COALESCE(greatest(CAST(lead(o.o_orderdate) OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey)
                               AS DATE) - 1, CAST(o.o_orderdate AS DATE)), DATE '{OPEN_END}') AS end_date
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "bank_txns": """SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS txn_date,
        CASE o_orderstatus WHEN 'O' THEN 'deposit' WHEN 'F' THEN 'withdrawal' ELSE 'purchase' END AS txn_type,
        CAST(floor(o_totalprice) AS BIGINT) AS txn_amount FROM orders""",
    "weekly_sales_raw": """SELECT strftime(CAST(date_trunc('week', l.l_shipdate) AS DATE), '%-d/%-m/%y') AS week_date,
        r.r_name AS region, CASE l.l_linestatus WHEN 'O' THEN 'Retail' ELSE 'Shopify' END AS platform,
        CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'null'
             ELSE (CASE WHEN c.c_custkey % 2 = 0 THEN 'C' ELSE 'F' END) || CAST(c.c_custkey % 4 + 1 AS VARCHAR) END AS segment,
        CASE l.l_returnflag WHEN 'R' THEN 'New' WHEN 'A' THEN 'Existing' ELSE 'Guest' END AS customer_type,
        CAST(count(*) AS BIGINT) AS transactions, CAST(sum(floor(l.l_extendedprice)) AS BIGINT) AS sales
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
        JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
        GROUP BY ALL""",
    "click_events": """SELECT CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS visit_id,
        user_id AS cookie_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS page_id,
        CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
             WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END AS BIGINT) AS event_type,
        ts AS event_time FROM events""",
    "click_users": """SELECT CAST(cookie_id // 3 AS BIGINT) AS user_id, cookie_id
        FROM (SELECT DISTINCT user_id AS cookie_id FROM events) u""",
}
SQL.update(dims.SQL)


def with_views(query: str) -> str:
    """Prefix ``query`` with the ``WITH`` definitions of every adapter view it names,
    dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name, body in SQL.items():
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in order:
                    order.append(name)

    visit(query)
    if not order:
        return query
    ctes = ",\n".join(f"{n} AS ({SQL[n]})" for n in order)
    q = query.lstrip()
    if q[:4].upper() == "WITH":
        return f"WITH {ctes},\n{q[4:]}"
    return f"WITH {ctes}\n{q}"


# ---------------------------------------------------------------- D2 ratings batch
def pizza_ratings_incoming(t: Tables, delivered_keys: DataFrame) -> DataFrame:
    """A ratings batch for the delivered orders: rating ``order_id % 7`` (0 and 6 break the
    1..5 rule), plus, for urgent orders, a second row naming the wrong customer."""
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderkey").alias("order_id"))
    good = delivered_keys.select("order_id", "runner_id", "customer_id", (F.col("order_id") % 7).alias("rating"))
    wrong = delivered_keys.join(urgent, "order_id", "left_semi").select(
        "order_id", "runner_id", (F.col("customer_id") + 1).alias("customer_id"), F.lit(5).cast("bigint").alias("rating"))
    return good.unionByName(wrong)


SQL.update({
    "pizza_orders_clean": """SELECT row_key AS id, order_id, customer_id, pizza_id,
        CASE WHEN exclusions IN ('null', '') THEN NULL ELSE exclusions END AS exclusions,
        CASE WHEN extras IN ('null', '') THEN NULL ELSE extras END AS extras, order_time
        FROM pizza_customer_orders""",
    "pizza_deliveries_clean": """SELECT order_id, runner_id,
        CAST(CASE WHEN pickup_time IN ('null', '') THEN NULL ELSE pickup_time END AS TIMESTAMP) AS pickup_time,
        CAST(nullif(regexp_extract(CASE WHEN distance IN ('null', '') THEN NULL ELSE distance END,
                                   '^\\s*([0-9]+(\\.[0-9]+)?)', 1), '') AS DECIMAL(8,1)) AS distance,
        CAST(nullif(regexp_extract(CASE WHEN duration IN ('null', '') THEN NULL ELSE duration END,
                                   '^\\s*([0-9]+)', 1), '') AS BIGINT) AS duration,
        CASE WHEN cancellation IN ('null', '') THEN NULL ELSE cancellation END AS cancellation
        FROM pizza_runner_orders""",
    "pizza_delivered_keys": """SELECT DISTINCT d.order_id, d.runner_id, o.customer_id
        FROM pizza_deliveries_clean d JOIN pizza_orders_clean o ON o.order_id = d.order_id
        WHERE d.cancellation IS NULL""",
    "pizza_ratings_incoming": """SELECT order_id, runner_id, customer_id, order_id % 7 AS rating FROM pizza_delivered_keys
        UNION ALL
        SELECT k.order_id, k.runner_id, k.customer_id + 1 AS customer_id, CAST(5 AS BIGINT) AS rating
        FROM pizza_delivered_keys k WHERE k.order_id IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
})
