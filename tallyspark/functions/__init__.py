"""Column helpers: dialect rules (week numbers, integer division, text lists) and exact rounding."""
