"""Weekly sales and the change date."""

from __future__ import annotations

from tallyspark.functions import dialect as D
from tallyspark.functions.exact import ratio_sql
from tallyspark.plans.retail import CHANGE_DATE, CHANGE_WEEK, IMPACT_DIMS
from tallyspark.sources.dims import AGE_BANDS, DEMOGRAPHICS

_D = D.tsql_date_dmy_sql("week_date")


def _named(key: str, pairs: list[tuple[str, str]]) -> str:
    """The value beside a key in two lists, Unknown for any other."""
    keys, values = ([p[i] for p in pairs] for i in (0, 1))
    return f"coalesce({values}[list_position({keys}, {key})], 'Unknown')"


_CLEAN = f"""weekly_clean AS (SELECT d AS week_date, {D.tsql_week_sql('d')} AS week_number, CAST(month(d) AS BIGINT) AS month_number,
            CAST(year(d) AS BIGINT) AS calendar_year, {_named('right(segment, 1)', AGE_BANDS)} AS age_band,
            {_named('left(segment, 1)', DEMOGRAPHICS)} AS demographic, {ratio_sql('sales', 'transactions', 2)} AS avg_transaction,
            transactions, sales, region, platform, customer_type
        FROM (SELECT *, {_D} AS d FROM weekly_sales_raw) raw)"""
# the Sunday that begins the change's week: a week of sales counts by the days between
_SUNDAY = f"(DATE '{CHANGE_DATE}' - CAST(dayofweek(DATE '{CHANGE_DATE}') AS INTEGER))"


def _before_after(group: str, before: str, after: str, names: tuple[str, str]) -> str:
    """Sales before and after, by a group or in all, in one pass; a group needs both."""
    b, a = names
    by = f"{group}, " if group else ""
    return f"""WITH {_CLEAN}, t AS (SELECT {by}CAST(sum(sales) FILTER (WHERE {before}) AS BIGINT) AS {b}, CAST(sum(sales) FILTER (WHERE {after}) AS BIGINT) AS {a}
            FROM weekly_clean {f'GROUP BY {group}' if group else ''})
        SELECT {by}{b}, {a}, {a} - {b} AS change_in_sales, {ratio_sql(f'{a} - {b}', b, 2, 100)} AS percentage_of_change
        FROM t {f'WHERE {b} + {a} IS NOT NULL' if group else ''}"""


def _weeks(first: int, last: int) -> str:
    """Whole weeks from the change's own (0)."""
    return f"week_date >= {_SUNDAY} + {7 * first} AND week_date < {_SUNDAY} + {7 * (last + 1)}"


def _overall(weeks: int) -> str:
    near = _weeks(-weeks, weeks - 1)
    return _before_after("", f"{near} AND week_date < DATE '{CHANGE_DATE}'", f"{near} AND week_date >= DATE '{CHANGE_DATE}'", ("before_total_sales", "after_total_sales"))


_BY_GROUP = ("total_sales_before", "total_sales_after")

SQL = {
    "retail_clean_weekly": f"WITH {_CLEAN} FROM weekly_clean",
    "retail_weekday": f"WITH {_CLEAN} SELECT week_date, {D.tsql_weekday_sql('week_date')} AS week_day FROM weekly_clean GROUP BY week_date",
    "retail_missing_weeks": f"WITH {_CLEAN} SELECT range AS week_range FROM range(1, 53) r EXCEPT SELECT week_number FROM weekly_clean",
    "retail_txn_by_year": f"WITH {_CLEAN} SELECT calendar_year AS year, CAST(sum(transactions) AS BIGINT) AS total_transactions FROM weekly_clean GROUP BY calendar_year",
    "retail_sales_region_month": f"""WITH {_CLEAN} SELECT region, calendar_year, month_number, CAST(sum(sales) AS BIGINT) AS total_sale
        FROM weekly_clean GROUP BY ALL""",
    "retail_txn_by_platform": "SELECT platform, CAST(sum(transactions) AS BIGINT) AS total_transactions FROM weekly_sales_raw GROUP BY ALL",
    "retail_platform_share": f"""WITH {_CLEAN}, s AS (SELECT calendar_year, month_number, platform, sum(sales) AS own FROM weekly_clean GROUP BY ALL)
        SELECT calendar_year, month_number, platform, CAST(own AS BIGINT) AS platform_monthly_sales,
            {ratio_sql('own', 'sum(own) OVER (PARTITION BY calendar_year, month_number)', 2, 100)} AS platform_perc FROM s""",
    "retail_demographic_share": f"""WITH {_CLEAN}, s AS (SELECT calendar_year, demographic, CAST(sum(sales) AS BIGINT) AS own FROM weekly_clean
            GROUP BY GROUPING SETS ((calendar_year, demographic), (calendar_year))),
        y AS (SELECT calendar_year, own AS yearly_sales FROM s WHERE demographic IS NULL)
        SELECT calendar_year, demographic, own AS demographic_sales, yearly_sales, {ratio_sql('own', 'yearly_sales', 2, 100)} AS demo_sales_perc
        FROM s JOIN y USING (calendar_year) WHERE demographic IS NOT NULL""",
    "retail_top_segments": f"""WITH {_CLEAN} SELECT age_band, demographic, CAST(sum(sales) AS BIGINT) AS total_sale
        FROM weekly_clean GROUP BY age_band, demographic, platform HAVING platform = 'Retail'""",
    "retail_avg_transaction": f"""WITH {_CLEAN} SELECT calendar_year, platform, {ratio_sql('sum(sales)', 'sum(transactions)', 2)} AS correct_avg,
            {ratio_sql('sum(CAST(avg_transaction * 100 AS BIGINT))', 'count(*) * 100', 2)} AS incorrect_avg FROM weekly_clean GROUP BY ALL""",
    "retail_period_flag": f"WITH {_CLEAN} SELECT *, if(week_date >= DATE '{CHANGE_DATE}', 'after', 'before') AS before_after FROM weekly_clean",
    "retail_before_after_4w": _overall(4),
    "retail_before_after_12w": _overall(12),
    "retail_before_after_by_year": _before_after("calendar_year", f"week_number - {CHANGE_WEEK} IN (-4, -3, -2, -1)", f"week_number - {CHANGE_WEEK} IN (0, 1, 2, 3)", _BY_GROUP),
}
for _dim in IMPACT_DIMS:
    SQL[f"retail_impact_{_dim}"] = _before_after(_dim, _weeks(-12, -1), _weeks(0, 11), _BY_GROUP)
