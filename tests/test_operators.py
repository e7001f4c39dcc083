"""Operators against brute force on small inputs."""

import datetime as dt
import random
from decimal import Decimal

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspark.operators.joins import interval_join, not_in
from tallyspark.operators.quantiles import percentile_cont
from tallyspark.operators.ranking import extreme_rows, rank_by_value
from tallyspark.operators.running import with_running_total
from tallyspark.operators.sequence import neighbours, preceding_sum


def test_interval_join_matches_brute_force(spark):
    base = dt.datetime(2024, 1, 1)
    pts = spark.createDataFrame([(i, base + dt.timedelta(hours=7 * i)) for i in range(200)] + [(200, None)], "id long, at timestamp_ntz")
    spans = [("a", 48, 5 * 24 + 23), ("b", 96, 216), ("c", 720, 744), ("open", 1000, None), ("before", -9000, -8000)]
    iv = spark.createDataFrame([(n, base + dt.timedelta(hours=s), dt.datetime(9999, 12, 31) if e is None else base + dt.timedelta(hours=e))
                                for n, s, e in spans], "name string, s timestamp_ntz, e timestamp_ntz")
    got = sorted((r["id"], r["name"] or "") for r in interval_join(pts, iv, "at", "s", "e").collect())
    hits = [(i, n) for i in range(200) for n, s, e in spans if s <= 7 * i <= (10**9 if e is None else e)]
    assert got == sorted(hits + [(i, "") for i in range(201) if i not in {j for j, _ in hits}])


def test_interval_join_with_many_intervals(spark):
    pts = spark.range(50).select("id", (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(F.col("id").cast("int"))).cast("timestamp_ntz").alias("at"))
    iv = spark.range(12_000).select(F.col("id").alias("k"), F.lit(dt.datetime(2023, 1, 1)).cast("timestamp_ntz").alias("s"),
                                    F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz").alias("e"))
    assert interval_join(pts, iv, "at", "s", "e", how="inner").count() == 2 * 12_000


def test_null_keys_are_kept(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, None, 6), (None, 2, 7), (None, 2, 8), (None, None, 9)], "g int, d int, v int")
    w = Window.partitionBy("g").orderBy("d")
    rows = lambda x: sorted(map(str, (tuple(r) for r in x.collect())))
    assert rows(with_running_total(df, ["g"], "d", "v", "t").select("g", "d", "v", "t")) == rows(df.select("g", "d", "v", F.sum("v").over(w).alias("t")))
    assert rows(rank_by_value(df, ["g"], "d", "rk").select("g", "d", "v", "rk")) == rows(df.select("g", "d", "v", F.rank().over(w).alias("rk")))
    total = Window.partitionBy("g").orderBy("d", "v")
    near = neighbours(df, ["g"], ["d", "v"], ["d"], ["v"])
    assert rows(near.select("g", "d", "v", "prev_v", "next_v")) == rows(df.select("g", "d", "v", F.lag("v").over(total), F.lead("v").over(total)))
    one = df.withColumn("one", F.lit(1))
    assert rows(preceding_sum(one, ["g"], ["d"], ["d"], "one", "n").select("g", "d", "v", "n")) == rows(df.select("g", "d", "v", F.rank().over(w) - 1))


def test_not_in_follows_the_null_rule(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 1)], "id int, k int")
    rows.createOrReplaceTempView("not_in_rows")
    for others in ([], [(2,)], [(2,), (2,), (9,)], [(2,), (None,)], [(None,)]):
        other = spark.createDataFrame(others, "k int")
        other.createOrReplaceTempView("not_in_others")
        want = spark.sql("SELECT id FROM not_in_rows WHERE k NOT IN (SELECT k FROM not_in_others)")
        assert sorted(r["id"] for r in not_in(rows, other, "k").collect()) == sorted(r["id"] for r in want.collect())


def test_percentile_cont_matches_numpy(spark):
    rnd = random.Random(7)
    data = [(g, rnd.randint(0, 40)) for g in range(4) for _ in range(rnd.randint(1, 60))]
    df = spark.createDataFrame(data, "g long, v long")
    got = {r["g"]: (r["p50"], r["p95"]) for r in percentile_cont(df, ["g"], "v", {"p50": 0.5, "p95": 0.95}).collect()}
    for g in range(4):
        vals = [v for gg, v in data if gg == g]
        for got_v, p in zip(got[g], (0.5, 0.95)):
            assert got_v == Decimal(str(round(float(np.percentile(vals, p * 100)), 4))).quantize(Decimal("0.0001"))


def test_rank_and_extremes_match_window(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(0, 3), dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 9)), i) for i in range(300)]
    df = spark.createDataFrame(data, "g long, d date, i long")
    w = Window.partitionBy("g").orderBy("d")
    expect = sorted((r["i"], r["rk"]) for r in df.select("i", F.rank().over(w).alias("rk")).collect())
    got = sorted((r["i"], r["rk"]) for r in rank_by_value(df, ["g"], "d", "rk").collect())
    assert got == expect
    firsts = sorted(r["i"] for r in extreme_rows(df, ["g"], "d").collect())
    assert firsts == sorted(i for i, rk in expect if rk == 1)


def test_running_total_range_frame(spark):
    data = [(1, dt.date(2020, 1, 1), 5), (1, dt.date(2020, 1, 1), -2), (1, dt.date(2020, 1, 3), 10), (2, dt.date(2020, 1, 2), 1)]
    df = spark.createDataFrame(data, "c long, d date, x long")
    got = sorted((r["c"], r["d"].day, r["x"], r["run"]) for r in with_running_total(df, ["c"], "d", "x", "run").collect())
    assert got == [(1, 1, -2, 3), (1, 1, 5, 3), (1, 3, 10, 13), (2, 2, 1, 1)]


def test_neighbours_and_rank_match_plain_windows(spark):
    from tallyspark.operators.sequence import neighbours, rank_in_order
    rnd = random.Random(11)
    data = [(rnd.choice([1, 1, 1, 2, 3]), dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 20)), i, rnd.randint(0, 9))
            for i in range(400)]
    df = spark.createDataFrame(data, "g long, d date, k long, x long")
    w = Window.partitionBy("g").orderBy("d", "k")
    expect = {r["k"]: (r["px"], r["nx"], r["nd"], r["rk"]) for r in df.select(
        "k", F.lag("x").over(w).alias("px"), F.lead("x").over(w).alias("nx"), F.lead("d").over(w).alias("nd"),
        F.rank().over(Window.partitionBy("g").orderBy("d")).alias("rk")).collect()}
    got_n = neighbours(df, ["g"], ["d", "k"], ["d"], ["x", "d"])
    got_r = rank_in_order(df, ["g"], ["d"], ["d"], "rk")
    rk = {r["k"]: r["rk"] for r in got_r.collect()}
    got = {r["k"]: (r["prev_x"], r["next_x"], r["next_d"], rk[r["k"]]) for r in got_n.collect()}
    assert got == expect


def test_preceding_sum_matches_brute_force(spark):
    from tallyspark.operators.sequence import preceding_sum
    rnd = random.Random(19)
    data = [(rnd.choice([1, 1, 1, 2]), rnd.randint(0, 400), rnd.randint(1, 5)) for _ in range(300)]
    df = spark.createDataFrame([(g, t, t // 100, w) for g, t, w in data], "g long, t long, b long, w long")
    got = sorted((r["g"], r["t"], r["w"], r["before"]) for r in preceding_sum(df, ["g"], ["t"], ["b"], "w", "before").collect())
    expect = sorted((g, t, w, sum(w2 for g2, t2, w2 in data if g2 == g and t2 < t)) for g, t, w in data)
    assert got == expect


def test_truncating_averages_follow_tsql(spark):
    from tallyspark.plans import balances as B
    nodes = spark.createDataFrame(
        [(1, 1, 1, dt.date(2020, 1, 1), dt.date(2020, 1, 15)), (2, 1, 2, dt.date(2020, 1, 1), dt.date(2020, 1, 16)),
         (3, 1, 3, dt.date(2020, 1, 1), dt.date(9999, 12, 31))],
        "customer_id long, region_id long, node_id long, start_date date, end_date date")
    assert B.avg_realloc_days(nodes).first()[0] == Decimal("14.500")
    assert B.avg_realloc_days(nodes, truncate=True).first()[0] == 14
    txns = spark.createDataFrame([(1, dt.date(2020, 1, 1), "deposit", 10), (1, dt.date(2020, 1, 2), "deposit", 15)],
                                 "customer_id long, txn_date date, txn_type string, txn_amount long")
    assert B.deposits_by_customer(txns).first()["average_amount"] == Decimal("12.50")
    assert B.deposits_by_customer(txns, truncate=True).first()["average_amount"] == 12
