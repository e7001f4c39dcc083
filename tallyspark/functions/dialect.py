"""Dialect rules of the case studies as pure ``Column`` helpers.

The case studies ran on PostgreSQL and SQL Server; a few of their built-ins have no
same-named Spark twin (T-SQL week numbers, week boundaries crossed, ISO weekday, epoch
minutes, NULL-as-empty CONCAT, dd/mm/yy with a two-digit-year pivot). Each is a
composition of built-in functions, so it stays inside whole-stage codegen.
Every helper has a DuckDB twin ``*_sql`` used only by the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A Sunday long before any data: T-SQL counts week boundaries as Sundays crossed.
SUNDAY_ANCHOR = "1899-12-31"
# T-SQL two-digit-year cutoff: 00-49 → 20yy, 50-99 → 19yy.
TWO_DIGIT_YEAR_PIVOT = 50


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def tsql_week(d) -> Column:
    """``DATEPART(week, d)``: weeks start on Sunday, week 1 holds 1 January."""
    d = _c(d)
    jan1_offset = F.dayofweek(F.trunc(d, "year")) - 1  # 0 when 1 Jan is a Sunday
    return ((F.dayofyear(d) - 1 + jan1_offset) / 7).cast("bigint") + 1


def tsql_week_sql(d: str) -> str:
    return f"CAST(((dayofyear({d}) - 1 + dayofweek(date_trunc('year', {d}))) // 7) + 1 AS BIGINT)"


def tsql_weekday(d) -> Column:
    """``DATEPART(weekday, d)`` with the default first day (Sunday = 1)."""
    return F.dayofweek(_c(d)).cast("bigint")


def tsql_weekday_sql(d: str) -> str:
    return f"CAST(dayofweek({d}) + 1 AS BIGINT)"


def tsql_weeks_between(a, b) -> Column:
    """``DATEDIFF(week, a, b)``: Sunday boundaries crossed going from ``a`` to ``b``."""
    anchor = F.lit(SUNDAY_ANCHOR).cast("date")
    wa = F.floor(F.datediff(_c(a), anchor) / 7)
    wb = F.floor(F.datediff(_c(b), anchor) / 7)
    return (wb - wa).cast("bigint")


def tsql_weeks_between_sql(a: str, b: str) -> str:
    return (f"CAST(floor(datediff('day', DATE '{SUNDAY_ANCHOR}', {b}) / 7) - "
            f"floor(datediff('day', DATE '{SUNDAY_ANCHOR}', {a}) / 7) AS BIGINT)")


def tsql_date_dmy(s) -> Column:
    """``CONVERT(DATE, s, 3)`` for ``d/m/yy`` text, two-digit years pivoting at 50."""
    parts = F.split(_c(s), "/")
    yy = parts.getItem(2).cast("int")
    year = F.when(yy < TWO_DIGIT_YEAR_PIVOT, yy + 2000).otherwise(yy + 1900)
    return F.make_date(year, parts.getItem(1).cast("int"), parts.getItem(0).cast("int"))


def tsql_date_dmy_sql(s: str) -> str:
    yy = f"CAST(split_part({s}, '/', 3) AS INTEGER)"
    return (f"make_date(CASE WHEN {yy} < {TWO_DIGIT_YEAR_PIVOT} THEN {yy} + 2000 ELSE {yy} + 1900 END, "
            f"CAST(split_part({s}, '/', 2) AS INTEGER), CAST(split_part({s}, '/', 1) AS INTEGER))")


def iso_weekday(ts) -> Column:
    """``EXTRACT(ISODOW ...)``: Monday = 1 … Sunday = 7."""
    return (F.weekday(_c(ts)) + 1).cast("bigint")


def iso_week(d) -> Column:
    """``EXTRACT(WEEK ...)``: the ISO week, whose first one holds 4 January."""
    return F.weekofyear(_c(d)).cast("bigint")


def iso_week_sql(d: str) -> str:
    return f"CAST(weekofyear({d}) AS BIGINT)"


def time_of_day(ts) -> Column:
    """``CAST(ts AS TIME)`` as ``HH:mm:ss`` text, from the parts of the wall-clock time."""
    ts = _c(ts)
    return F.when(ts.isNotNull(), F.format_string("%02d:%02d:%02d", F.hour(ts), F.minute(ts), F.second(ts)))


def time_of_day_sql(ts: str) -> str:
    return f"strftime({ts}, '%H:%M:%S')"


def seconds_between(later, earlier) -> Column:
    """Whole seconds from ``earlier`` to ``later`` (``EXTRACT(EPOCH FROM later - earlier)``) for
    wall-clock timestamps: days apart × 86400 plus the time-of-day difference, so no
    session time zone (and no DST gap) is involved."""
    a, b = _c(earlier), _c(later)

    def tod(t):
        return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)

    return (F.datediff(F.to_date(b), F.to_date(a)).cast("bigint") * 86400 + tod(b) - tod(a)).cast("bigint")


def seconds_between_sql(later: str, earlier: str) -> str:
    return f"datediff('second', {earlier}, {later})"


def concat_nullsafe(*cols) -> Column:
    """PostgreSQL ``CONCAT``: NULL arguments count as empty text."""
    return F.concat_ws("", *[_c(c) for c in cols])


def null_if_text(c, values=("null", "")) -> Column:
    """Text placeholders for missing values → NULL (``UPDATE … SET c = NULL WHERE c IN (…)``)."""
    c = _c(c)
    return F.when(~c.isin(*values), c)


def split_list(c, sep: str = ",") -> Column:
    """``string_to_array(c, sep)`` with every element trimmed; NULL text gives NULL."""
    return F.transform(F.split(_c(c), sep), lambda x: F.trim(x))


def unnest(df: DataFrame, outer: bool = False, **arrays) -> DataFrame:
    """``df`` with a row per element of the arrays, side by side (``SELECT unnest(a) AS x, unnest(b) AS y``): the k-th
    elements of all stand in one row, and arrays that have ended give NULL.

    A NULL array counts as an empty one. A row whose arrays are all empty goes, as in PostgreSQL, or stays with
    NULLs (``outer``). Columns of ``df`` with the same names are replaced.
    """
    lists = [F.coalesce(_c(a), F.array()).alias(name) for name, a in arrays.items()]
    together = F.arrays_zip(*lists)
    element = (F.explode_outer if outer else F.explode)(together).alias("__element")
    rest = [F.col(f"`{c}`") for c in df.columns if c not in arrays]
    return df.select(*rest, element).select(*rest, *[F.col("__element")[name].alias(name) for name in arrays])


def leading_number(c) -> Column:
    """The leading number of text such as ``'23.4 km'`` or ``'25mins'``; NULL if none."""
    return F.nullif(F.regexp_extract(_c(c), r"^\s*([0-9]+(\.[0-9]+)?)", 1), F.lit(""))


def leading_number_sql(c: str) -> str:
    return f"nullif(regexp_extract({c}, '^\\s*([0-9]+(\\.[0-9]+)?)', 1), '')"
