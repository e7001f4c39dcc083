"""DuckDB text of every registered key: the correctness oracle. Nothing in the package imports it.

The texts are written from the questions, by other means than the Spark plans where there is a choice: lists,
one-pass filters, self-joins and recursion in place of the plans' two-level windows and joins back.
"""

from __future__ import annotations

from oracle_texts import balances, loyalty, orders, retail, subscriptions, web
from tallyspark.sources.adapters import with_views

SQL: dict[str, str] = {}
for _family in (loyalty, orders, subscriptions, balances, retail, web):
    SQL |= _family.SQL


def oracle_sql() -> dict[str, str]:
    """Every key's text with the views that it reads."""
    return {key: with_views(text) for key, text in SQL.items()}
