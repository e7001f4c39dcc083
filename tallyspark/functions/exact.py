"""Exact rounding of ratios, the same in Spark and in the DuckDB oracle.

``round(100.0 * a / b, 2)`` goes through a double in DuckDB and through a decimal in
Spark, and the two round ties differently. Here every fractional result is an integer
ratio rounded half away from zero (PostgreSQL numeric and T-SQL both round that way)
by integer arithmetic, then scaled into a fixed ``DECIMAL(p, s)``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

OUT_PRECISION = 24


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def ratio(num, den, scale: int = 2, mult: int = 1) -> Column:
    """``round(mult * num / den, scale)`` half away from zero as ``decimal(24, scale)``.

    ``num`` and ``den`` must be integer-valued (counts, sums of integers). NULL when
    ``den`` is 0 or NULL.
    """
    n = _c(num).cast("decimal(38,0)") * F.lit(mult * 10**scale).cast("decimal(38,0)")
    q = _c(den).cast("decimal(38,0)")
    a = F.abs(n) * 2 + F.abs(q)
    b = F.abs(q) * 2
    whole = ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")
    neg = (n < 0) != (q < 0)
    signed = F.when(neg & (n != 0), -whole).otherwise(whole)
    unit = F.lit(Decimal(1).scaleb(-scale)) if scale > 0 else F.lit(Decimal(1))
    out = (signed.cast("decimal(30,0)") * unit).cast(f"decimal({OUT_PRECISION},{scale})")
    return F.when(q != 0, out)


def ratio_sql(num: str, den: str, scale: int = 2, mult: int = 1) -> str:
    """DuckDB text of :func:`ratio`."""
    n = f"(CAST({num} AS HUGEINT) * {mult * 10**scale})"
    q = f"CAST(NULLIF({den}, 0) AS HUGEINT)"
    whole = f"((2 * abs({n}) + abs({q})) // (2 * abs({q})))"
    signed = f"(CASE WHEN ({n} < 0) <> ({q} < 0) AND {n} <> 0 THEN -{whole} ELSE {whole} END)"
    unit = f"{Decimal(1).scaleb(-scale)}" if scale > 0 else "1"
    return f"CAST(CAST({signed} AS DECIMAL(30,0)) * {unit} AS DECIMAL({OUT_PRECISION},{scale}))"


def int_div(num, den) -> Column:
    """Integer division truncating toward zero (T-SQL ``int / int``, PostgreSQL ``div``).

    Both sides are whole numbers of 64 bits. NULL when ``den`` is 0 or NULL.
    """
    n, d = _c(num).cast("bigint"), _c(den).cast("bigint")
    return F.when(d != 0, F.call_function("div", n, d))


def int_div_sql(num: str, den: str) -> str:
    return f"CAST(CAST({num} AS HUGEINT) // CAST(NULLIF({den}, 0) AS HUGEINT) AS BIGINT)"
