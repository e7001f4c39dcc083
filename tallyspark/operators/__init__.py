"""Reusable DataFrame operators: skew-safe top-per-group and ranking, running totals,
interval joins, date series, data-quality checks and materialisation."""
