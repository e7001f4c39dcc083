"""Date and number series (``generate_series``) as array expressions.

Series are built per row with ``sequence``/``aggregate`` and exploded, so they are
generated inside the task that owns the row; no driver-side loop, no join to a calendar.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def monthly_dates_drifting(start, steps) -> Column:
    """``[start, start+1 month, …]`` with ``steps`` increments (one at least), each step added to the
    previous value (PostgreSQL ``generate_series`` with a month interval): 31 Jan →
    29 Feb → 29 Mar, not 31 Mar.

    The day once cut by a month's end stays cut, so the k-th day is the start's, limited by the shortest month among
    the k passed. That is known for each k by itself: 30 from the first shorter month on, 29 from the first
    February on, 28 from the first February of no leap year on, which is the first or the next.
    """
    start = start if isinstance(start, Column) else F.col(start)
    month, year = F.month(start), F.year(start)
    to_feb = F.when(month < 2, 2 - month).otherwise(14 - month)
    feb_year = F.when(month < 2, year).otherwise(year + 1)
    leap = ((feb_year % 4 == 0) & (feb_year % 100 != 0)) | (feb_year % 400 == 0)
    to_28 = F.when(leap, to_feb + 12).otherwise(to_feb)
    to_30 = F.least(*[F.pmod(F.lit(m) - month - 1, F.lit(12)) + 1 for m in (4, 6, 9, 11)])
    first = F.trunc(start, "month")

    def step(k: Column) -> Column:
        longest = F.when(k >= to_28, 28).when(k >= to_feb, 29).when(k >= to_30, 30).otherwise(31)
        day = F.when(k == 0, F.dayofmonth(start)).otherwise(F.least(F.dayofmonth(start), longest))
        return F.date_add(F.add_months(first, k), day - 1)

    return F.transform(F.sequence(F.lit(0), F.greatest(steps, F.lit(1))), step)


def bucket_starts(max_value, width: int) -> Column:
    """``generate_series(0, max_value + width, width)`` as an array."""
    return F.sequence(F.lit(0).cast("bigint"), (max_value + width).cast("bigint"), F.lit(width).cast("bigint"))
