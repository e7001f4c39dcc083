"""Layer 3: dialect rules at their edges (year ends, Sundays, ties, month ends)."""

import datetime as dt
from decimal import Decimal

import duckdb
from pyspark.sql import functions as F

from tallyspark.functions import dialect as D
from tallyspark.functions.exact import int_div, int_div_sql, ratio, ratio_sql
from tallyspark.operators.series import monthly_dates_drifting

DATES = ["2018-01-01", "2019-12-31", "2020-01-01", "2020-01-04", "2020-01-05", "2020-06-14", "2020-06-15",
         "2020-12-31", "2021-01-01", "2021-01-03", "2022-01-01", "2023-01-01"]


def test_tsql_week_matches_duckdb_twin_and_rule(spark):
    df = spark.createDataFrame([(dt.date.fromisoformat(x),) for x in DATES], "d date")
    got = {r["d"].isoformat(): r["w"] for r in df.select("d", D.tsql_week("d").alias("w")).collect()}
    con = duckdb.connect()
    for x in DATES:
        assert got[x] == con.execute(f"SELECT {D.tsql_week_sql(f'DATE {chr(39)}{x}{chr(39)}')}").fetchone()[0]
    # 1 Jan is always week 1; the first Sunday after it starts week 2
    assert got["2020-01-01"] == 1 and got["2020-01-04"] == 1 and got["2020-01-05"] == 2
    assert got["2021-01-01"] == 1 and got["2021-01-03"] == 2 and got["2023-01-01"] == 1
    assert got["2020-12-31"] == 53


def test_weeks_between_counts_sundays(spark):
    df = spark.createDataFrame([(dt.date(2020, 6, 13), dt.date(2020, 6, 15)), (dt.date(2020, 6, 14), dt.date(2020, 6, 15)),
                                (dt.date(2020, 6, 15), dt.date(2020, 6, 15)), (dt.date(2020, 6, 22), dt.date(2020, 6, 15))],
                               "a date, b date")
    got = [r[0] for r in df.select(D.tsql_weeks_between("a", "b")).collect()]
    assert got == [1, 0, 0, -1]


def test_dmy_two_digit_year_pivot(spark):
    df = spark.createDataFrame([("9/6/98",), ("31/12/49",), ("1/1/50",), ("15/6/20",)], "s string")
    got = [r[0] for r in df.select(D.tsql_date_dmy("s")).collect()]
    assert got == [dt.date(1998, 6, 9), dt.date(2049, 12, 31), dt.date(1950, 1, 1), dt.date(2020, 6, 15)]


def test_iso_weekday_and_tsql_weekday(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2021, 1, 4),)], "d date")  # Sunday, Monday
    got = [(r[0], r[1]) for r in df.select(D.iso_weekday("d"), D.tsql_weekday("d")).collect()]
    assert got == [(7, 1), (1, 2)]


def test_ratio_rounds_half_away_from_zero_like_duckdb_twin(spark):
    cases = [(57, 200), (-57, 200), (1, 3), (2, 3), (-2, 3), (1, 8), (5, 0), (0, 7), (10**15 + 1, 7)]
    df = spark.createDataFrame(cases, "n long, d long")
    got = [r[0] for r in df.select(ratio("n", "d", 2, mult=1)).collect()]
    assert got[:3] == [Decimal("0.29"), Decimal("-0.29"), Decimal("0.33")]
    assert got[5] == Decimal("0.13") and got[6] is None and got[7] == Decimal("0.00")
    con = duckdb.connect()
    for (n, d), g in zip(cases, got):
        assert con.execute(f"SELECT {ratio_sql(str(n), str(d), 2)}").fetchone()[0] == g


def test_int_div_truncates_toward_zero(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (7, -2), (1, 0)], "n long, d long")
    got = [r[0] for r in df.select(int_div("n", "d")).collect()]
    assert got == [3, -3, -3, None]
    con = duckdb.connect()
    assert [con.execute(f"SELECT {int_div_sql(f'({n})', f'({d})')}").fetchone()[0] for n, d in
            [(7, 2), (-7, 2), (7, -2), (1, 0)]] == got


def test_monthly_series_drifts_like_postgres(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 31),), (dt.date(2019, 10, 31),), (dt.date(2020, 5, 15),)], "s date")
    got = [r["d"] for r in df.select(monthly_dates_drifting("s", F.lit(5)).alias("d")).collect()]
    assert got[0][:4] == [dt.date(2020, 1, 31), dt.date(2020, 2, 29), dt.date(2020, 3, 29), dt.date(2020, 4, 29)]
    assert got[1] == [dt.date(2019, 10, 31), dt.date(2019, 11, 30), dt.date(2019, 12, 30), dt.date(2020, 1, 30),
                      dt.date(2020, 2, 29), dt.date(2020, 3, 29)]
    assert got[2] == [dt.date(2020, m, 15) for m in range(5, 11)]
    con = duckdb.connect()
    for start, series in zip(["2020-01-31", "2019-10-31", "2020-05-15"], got):
        ref = [r[0].date() for r in con.execute(
            f"SELECT unnest(generate_series(TIMESTAMP '{start}', TIMESTAMP '{start}' + INTERVAL 5 MONTH, "
            "INTERVAL 1 MONTH))").fetchall()]
        assert series == ref[:len(series)]


def test_leading_number_and_null_text(spark):
    df = spark.createDataFrame([("23.4 km",), ("13.4km",), ("25mins",), ("null",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(D.leading_number(D.null_if_text("s"))).collect()]
    assert got == ["23.4", "13.4", "25", None, None, None]


def test_week_rules_agree_with_duckdb_twins_on_random_dates(spark):
    import random
    rnd = random.Random(5)
    days = sorted({dt.date(1990, 1, 1) + dt.timedelta(days=rnd.randint(0, 16000)) for _ in range(1500)})
    anchor = dt.date(2001, 6, 15)
    df = spark.createDataFrame([(x,) for x in days], "d date")
    got = {r["d"]: (r["w"], r["wd"], r["wb"]) for r in df.select(
        "d", D.tsql_week("d").alias("w"), D.tsql_weekday("d").alias("wd"),
        D.tsql_weeks_between("d", F.lit(anchor)).alias("wb")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(d DATE)")
    con.executemany("INSERT INTO t VALUES (?)", [(x,) for x in days])
    rows = con.execute(f"SELECT d, {D.tsql_week_sql('d')}, {D.tsql_weekday_sql('d')}, "
                       f"{D.tsql_weeks_between_sql('d', 'DATE ' + repr(anchor.isoformat()))} FROM t").fetchall()
    assert {d: (w, wd, wb) for d, w, wd, wb in rows} == got
    # the text round trip used by the weekly view: d/M/yy → date
    txt = df.select("d", F.date_format("d", "d/M/yy").alias("s")).select("d", D.tsql_date_dmy("s").alias("back"))
    assert all(r["d"] == r["back"] for r in txt.collect() if 1950 <= r["d"].year <= 2049)


def test_iso_week_and_time_of_day(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE '2021-01-01', TIMESTAMP_NTZ '2021-01-01 09:05:07'), (DATE '2021-01-04', NULL), (DATE '2020-12-31', TIMESTAMP_NTZ '2020-12-31 23:59:59') AS t(d, ts)")
    got = [tuple(r) for r in df.select(D.iso_week("d"), D.time_of_day("ts")).collect()]
    assert got == [(53, "09:05:07"), (1, None), (53, "23:59:59")]
