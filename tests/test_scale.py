"""Operators that keep their work spread whatever a key holds, against plain windows, SQL or brute force."""

import datetime as dt
import os
import random
import re
import statistics
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspark.functions import dialect as D
from tallyspark.operators import materialize as M
from tallyspark.operators.joins import dyadic_cover, interval_join, join_back, not_in, salted_join_back
from tallyspark.operators.kept import KeptTable, new_table
from tallyspark.operators.ordered import Ordered, arranged, kept_in_order, write_ordered
from tallyspark.operators.prefix import scan
from tallyspark.operators.quality import validate_batch
from tallyspark.operators.quantiles import percentile_cont
from tallyspark.operators.ranges import range_aggregate
from tallyspark.operators.series import monthly_dates_drifting


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def plan(df):
    """The plan as run: final parts, without what they were planned from."""
    df.collect()
    out, skipped = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skipped is not None and depth > skipped:
            continue
        skipped = depth - 1 if "== Initial Plan ==" in line else None
        if skipped is None:
            out.append(line)
    return "\n".join(out)


def per_partition(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


# -- ordered files ---------------------------------------------------------------------------------

def test_files_read_back_in_order(spark, tmp_path):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("k"), F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50).alias("g"), F.col("id").cast("string").alias("s"))
    kept = write_ordered(df, ["g", "k"], str(tmp_path / "o"), files=7)
    files = sorted(f for f in os.listdir(tmp_path / "o" / "data") if f.endswith(".parquet"))
    read = [r for f in files for r in pq.read_table(tmp_path / "o" / "data" / f).to_pylist()]
    want = sorted(((r["g"], r["k"], r["s"]) for r in df.collect()))
    assert [(r["g"], r["k"], r["s"]) for r in read] == want
    # a third of the rows have one g, yet no file holds more than twice its share
    assert len(files) == 7 and max(pq.read_table(tmp_path / "o" / "data" / f).num_rows for f in files) < 2 * 20_000 / 7
    placed = {r["position"]: (r["g"], r["k"], r["s"]) for r in Ordered(spark, kept.path).rows().collect()}
    assert [placed[i + 1] for i in range(20_000)] == want


def test_pages_read_their_files_only(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), (-F.col("id")).alias("k"))
    kept = write_ordered(df, [F.col("id").desc()], str(tmp_path / "o"), files=10)
    for offset, count in ((0, 5), (95, 20), (990, 50), (1000, 5), (5000, 5), (10, 0)):
        page = kept.page(offset, count)
        assert [(r["position"], r["id"]) for r in page.collect()] == [(i + 1, 999 - i) for i in range(1000)][offset : offset + count]
        assert len(page.inputFiles()) <= 3


def test_one_value_is_spread_over_files(spark, tmp_path):
    kept = write_ordered(spark.range(9000).select(F.lit(1).alias("k"), "id"), ["k"], str(tmp_path / "o"), files=9)
    assert kept.manifest().count() == 9 and max(r["rows"] for r in kept.manifest().collect()) < 2000
    assert sorted(r["position"] for r in kept.rows().collect()) == list(range(1, 9001))


def test_order_of_nothing_and_no_single_partition(spark):
    empty = kept_in_order(spark.range(0).select("id"), ["id"], "none")
    assert empty.rows().collect() == [] and empty.page(0, 5).collect() == [] and empty.rows().columns == ["position", "id"]
    text = plan(arranged(spark.range(1000).select("id"), ["id"]))
    assert "rangepartitioning" in text and "SinglePartition" not in text


# -- kept tables -----------------------------------------------------------------------------------

def test_a_batch_is_appended_once(spark, tmp_path):
    table = KeptTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert table.append(first, "one") and not table.append(first, "one")
    assert not KeptTable(spark, str(tmp_path / "t")).append(first, "one")  # a second run
    assert table.append(first.select("v", "k").where("k > 1"), "two", key=["k"])  # its key is there
    assert table.append(spark.createDataFrame([(None, "n"), (3, "c"), (2, "x")], "k int, v string"), "three", key=["k"])
    assert table.append(spark.createDataFrame([(None, "m")], "k int, v string"), "four", key=["k"])
    assert table.append(first.limit(0), "five")
    assert rows(table.read()) == rows(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (3, "c")], "k int, v string"))
    with pytest.raises(ValueError):
        table.append(spark.createDataFrame([(1,)], "k int"), "six")
    for name in ("", "a/b", ".x", "_x"):
        with pytest.raises(ValueError):
            table.append(first, name)


def test_attempts_that_died_are_never_read(spark, tmp_path):
    table = KeptTable(spark, str(tmp_path / "t"))
    first = spark.createDataFrame([(1, "a")], "k int, v string")
    first.write.parquet(str(tmp_path / "t" / "data" / "one-died"))  # its record never came
    assert table.append(first, "one") and table.read().count() == 1
    # two runs at once: the record of the slower one doesn't replace the first
    assert table._commit("two", "two-fast") and not table._commit("two", "two-slow")
    assert table.attempts()[1] == "two-fast"
    assert [f for f in os.listdir(tmp_path / "t" / "commits") if not f.endswith(".crc")] == ["one", "two"]


def test_new_tables_are_apart(spark):
    a, b = new_table(spark, "t"), new_table(spark, "t")
    assert a.append(spark.range(2), "x") and b.append(spark.range(3), "x")
    assert (a.read().count(), b.read().count()) == (2, 3)


# -- prefix scan -----------------------------------------------------------------------------------

@pytest.mark.parametrize("seed,ranges", [(1, 3), (2, 8), (3, 40)])
def test_scan_equals_plain_windows(spark, seed, ranges):
    rnd = random.Random(seed)
    data = [(rnd.choice([1, 1, 1, 1, 1, 1, 2, 3, None]), rnd.choice([5, 5, 5, 6, None]), i, rnd.choice([None, 1, 2, 3])) for i in range(1500)]
    df = spark.createDataFrame(data, "g int, d int, k int, v int").repartition(5)
    for group, order in ((["g"], ["d", "k"]), (["g", "d"], ["k"]), ([], ["k"])):
        w = Window.partitionBy(*group).orderBy(*order)
        upto = F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
        want = df.select("*", F.lag("v").over(w), F.lead("v").over(w), F.lead("k").over(w), F.row_number().over(w).cast("bigint"), upto)
        got = scan(df, group, order, prev=["v"], nxt=["v", "k"], number="rn", running={"t": "v"}, ranges=ranges)
        assert got.columns == [*df.columns, "prev_v", "next_v", "next_k", "rn", "t"]
        assert rows(got) == rows(want)


def test_scan_of_nothing(spark):
    df = spark.createDataFrame([], "g int, k int")
    assert scan(df, ["g"], ["k"], prev=["k"], number="n").collect() == []


def test_scan_splits_a_hot_day(spark):
    """Two thirds of the rows in one (customer, day): no task has more than twice the median."""
    df = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 500).alias("c"), F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 90).alias("d"), "id")
    got = scan(df, ["c"], ["d", "id"], nxt=["id"], number="n", ranges=24)
    counts = per_partition(got)
    assert len(counts) == 24 and max(counts) <= 2 * statistics.median(counts)
    assert got.where("c = 7").agg(F.max("n")).first()[0] == df.where("c = 7").count()
    assert "SinglePartition" not in plan(got).split("BroadcastExchange")[0]


# -- percentiles -----------------------------------------------------------------------------------

@pytest.mark.parametrize("kind", ["tinyint", "int", "bigint"])
def test_percentiles_by_refinement(spark, kind):
    rnd = random.Random(11)
    top = {"tinyint": 100, "int": 2**31 - 1, "bigint": 2**62}[kind]
    data = [(rnd.choice(["a", "a", "b", None]), rnd.choice([None, rnd.randint(-top, top), rnd.randint(-5, 5)])) for _ in range(900)] + [("one", 3), ("none", None)]
    df = spark.createDataFrame(data, "g string, v long").select("g", F.col("v").cast(kind).alias("v"))
    got = {r["g"]: (r["q0"], r["q3"], r["q1"]) for r in percentile_cont(df, ["g"], "v", {"q0": 0.0, "q3": 0.375, "q1": 1.0}).collect()}
    want = {}
    for g in {g for g, _ in data}:
        vs = sorted(v for h, v in data if h == g and v is not None)
        if vs:
            at = Decimal(len(vs) - 1) * Decimal("0.375")
            lo, f = int(at), at - int(at)
            mid = Decimal(vs[lo]) + f * (vs[min(lo + 1, len(vs) - 1)] - vs[lo])
            want[g] = (Decimal(vs[0]), mid.quantize(Decimal("0.0001"), "ROUND_HALF_UP"), Decimal(vs[-1]))
    assert got == want


def test_a_group_of_many_values_is_spread(spark):
    """A million values in one group: no task of the windows gets more than a range's share."""
    df = spark.range(1_000_000).select(F.lit(1).alias("g"), ((F.col("id") * 48_271) % 2_147_483_647).cast("int").alias("v"))
    q = percentile_cont(df, ["g"], "v", {"m": 0.5})
    want = df.agg(F.percentile("v", 0.5)).first()[0]
    assert float(q.first()["m"]) == want
    per = df.groupBy("g", F.shiftright("v", 16).alias("r")).count()
    assert per.count() <= 2**16 and per.agg(F.max("count")).first()[0] < 1_000_000 / 1000


# -- intervals and ranges --------------------------------------------------------------------------

def test_dyadic_cover(spark):
    rnd = random.Random(4)
    pairs = [(a := rnd.randint(-500, 3000), a + rnd.choice([-3, 0, 1, 2, 7, 100, 900])) for _ in range(300)]
    got = spark.createDataFrame(pairs, "a int, b int").select("a", "b", dyadic_cover(F.col("a"), F.col("b")).alias("c")).collect()
    for a, b, c in got:
        days = [x for s in c for x in range(s["node"] << s["level"], (s["node"] + 1) << s["level"])]
        assert sorted(days) == list(range(a, b + 1)) and all(sum(t["level"] == s["level"] for t in c) <= 2 for s in c)


def test_ten_thousand_long_intervals_stay_few_rows(spark):
    iv = spark.range(10_001).select(F.expr("date_add(DATE'1990-01-01', cast(id % 700 as int))").alias("s"))
    nodes = iv.select(F.explode(dyadic_cover(F.datediff("s", F.lit("0001-01-01").cast("date")), F.datediff(F.date_add("s", 10_950), F.lit("0001-01-01").cast("date")))))
    assert nodes.count() < 400_000


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_against_sql(spark, how):
    rnd = random.Random(9)
    base = dt.datetime(2023, 12, 20)
    at = lambda h: base + dt.timedelta(hours=h)
    points = [(i, None if i % 17 == 0 else at(rnd.randint(0, 2000))) for i in range(150)] + [(3, at(5)), (3, at(5))]
    spans = [(n, at(a := rnd.randint(-300, 2100)), at(a + rnd.choice([-5, 0, 1, 30, 500, 9000]))) for n in range(40)] + [(90, None, at(5)), (91, at(5), dt.datetime(9999, 12, 31))]
    p, s = spark.createDataFrame(points, "i long, t timestamp_ntz"), spark.createDataFrame(spans, "n long, a timestamp_ntz, b timestamp_ntz")
    want = p.join(s, (p.t >= s.a) & (p.t <= s.b), how)
    assert rows(interval_join(p, s, "t", "a", "b", how)) == rows(want)
    none = interval_join(p, s.limit(0), "t", "a", "b", how)
    assert none.count() == (len(points) if how == "left" else 0) and none.columns == want.columns


def test_interval_join_reads_points_once(spark, tmp_path):
    spark.range(100).select(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id as int))").alias("t")).write.parquet(str(tmp_path / "points"))
    s = spark.sql("SELECT timestamp_ntz'2024-01-05 00:00:00' AS a, timestamp_ntz'2024-02-05 00:00:00' AS b")
    text = plan(interval_join(spark.read.parquet(str(tmp_path / "points")), s, "t", "a", "b"))
    assert len(re.findall("Scan parquet|FileScan parquet", text)) == 1 and "NestedLoop" not in text and "Cartesian" not in text


def test_aggregates_over_any_ranges(spark):
    rnd = random.Random(2)
    values = [rnd.choice([None, rnd.randint(-20, 60), 7]) for _ in range(400)]
    spans = [(rnd.randint(-30, 70), rnd.randint(-30, 70)) for _ in range(40)] + [(7, 7), (7, 7), (None, 3), (3, None), (500, 900), (-30, 70)]
    got = range_aggregate(spark.createDataFrame([(v,) for v in values], "v int"), "v", spark.createDataFrame(spans, "l int, h int"), "l", "h")
    want = []
    for low, high in spans:
        inside = [v for v in values if v is not None and None not in (low, high) and low <= v <= high]
        want.append((low, high, len(inside), sum(inside) if inside else None))
    assert rows(got) == sorted(map(str, want))
    text = plan(got)
    assert "NestedLoop" not in text and "Cartesian" not in text


# -- joins back, lists, checks, series -------------------------------------------------------------

def test_salted_join_back_spreads_a_hot_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 1).when(F.col("id") % 300 == 0, None).otherwise(F.col("id") % 97 + 2).alias("k"), "id")
    per = df.groupBy("k").agg(F.count(F.lit(1)).alias("w"), F.max("id").alias("top"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = salted_join_back(df, per, ["k"], ["id"], "w", salts=64)
        counts = per_partition(got)
        assert max(counts) <= 2 * statistics.median(counts)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert rows(got.select("k", "id", "top")) == rows(join_back(df, per.drop("w"), ["k"]).select("k", "id", "top"))


def test_not_in_reads_its_list_once(spark, tmp_path):
    spark.range(50).select(F.when(F.col("id") != 9, F.col("id")).alias("k")).write.parquet(str(tmp_path / "list"))
    listed = spark.read.parquet(str(tmp_path / "list"))
    assert not_in(spark.range(100).select(F.col("id").alias("k")), listed, "k").count() == 0
    left = not_in(spark.range(100).select(F.col("id").alias("k")), listed.where("k IS NOT NULL"), "k")
    text = plan(left)
    assert left.count() == 51 and len(re.findall("Scan parquet|FileScan parquet", text)) == 1 and "NestedLoop" not in text


def test_unnest_side_by_side(spark):
    df = spark.createDataFrame([(1, [1, 2], [5]), (2, None, [6, 7]), (3, [], None), (4, [8], []), (5, [None], [9])], "i int, a array<int>, b array<int>")
    assert rows(D.unnest(df, x="a", y="b").select("i", "x", "y")) == sorted(map(str, [(1, 1, 5), (1, 2, None), (2, None, 6), (2, None, 7), (4, 8, None), (5, None, 9)]))
    assert D.unnest(df, outer=True, x="a", y="b").count() == 7
    assert D.unnest(df, a="a").columns == ["i", "b", "a"]


def test_validation_shuffles_once_on_the_key(spark):
    batch = spark.createDataFrame([(1, 1, 5), (1, 1, 5), (2, 1, 9), (3, 9, 1), (4, 1, None), (5, None, 3), (6, 1, 4), (6, 2, 4), (7, 1, 2), (7, 9, 2)], "k int, m int, r int")
    ref = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, None), (6, 1), (6, 2), (7, 1), (8, 1)], "k int, m int")
    got = validate_batch(batch, ref, ["k"], ["k", "m"], "r", 1, 5)
    d, u, o = "duplicate key", "unknown key", "rating out of range"
    assert rows(got) == sorted(map(str, [(1, 1, 5, d), (1, 1, 5, d), (2, 1, 9, o), (3, 9, 1, u), (4, 1, None, o), (5, None, 3, u), (6, 1, 4, d), (6, 2, 4, d), (7, 1, 2, None), (7, 9, 2, u)]))
    text = plan(got)
    assert len(re.findall(r"Exchange hashpartitioning\(k#\d+, \d+\)", text)) == 1 and "Join" not in text


def test_drifting_series_of_a_century(spark):
    starts = [dt.date(y, m, d) for y in (1999, 2000, 2003, 2004, 1899) for m in range(1, 13) for d in (1, 28, 29, 30, 31) if d <= 28 or (d <= 30 and m != 2) or m in (1, 3, 5, 7, 8, 10, 12)]
    got = spark.createDataFrame([(s,) for s in starts], "s date").select("s", monthly_dates_drifting("s", F.lit(1200)).alias("d")).collect()
    for s, dates in got:
        assert len(dates) == 1201
        day, want = s.day, s
        for k, found in enumerate(dates):
            if k:
                y, m = divmod(want.year * 12 + want.month, 12)
                last = (dt.date(y + (m == 11), (m + 1) % 12 + 1, 1) - dt.timedelta(1)).day
                day = min(want.day, last)
                want = dt.date(y, m + 1, day)
            assert found == want


# -- change tokens ---------------------------------------------------------------------------------

def test_other_tables_rebuild_nothing(spark, tmp_path):
    from tallyspark.sources.tables import Tables

    for name in ("region", "nation"):
        spark.range(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    built = []

    def view():
        t = Tables(spark, str(tmp_path))
        inner = lambda: t.view("inner", lambda: built.append("inner") or t.region)
        return t.view("outer", lambda: built.append("outer") or inner().unionByName(inner())).count()

    assert view() == 6 and built == ["outer", "inner"]
    spark.range(5).write.mode("append").parquet(str(tmp_path / "nation.parquet"))
    assert view() == 6 and built == ["outer", "inner"]
    spark.range(1).write.mode("append").parquet(str(tmp_path / "region.parquet"))
    assert view() == 8 and built == ["outer", "inner"] * 2


def test_token_of_many_files(spark, tmp_path):
    folder = tmp_path / "many"
    (folder / "p=1").mkdir(parents=True)
    for i in range(10_000):
        (folder / f"f{i}.parquet").write_bytes(b"x")
    began = dt.datetime.now()
    one = M.change_token(spark, str(folder))
    assert (dt.datetime.now() - began).total_seconds() < 20 and one[0] == 10_000
    assert M.change_token(spark, str(folder)) == one
    (folder / "p=1" / "new.parquet").write_bytes(b"y")
    assert M.change_token(spark, str(folder)) != one
