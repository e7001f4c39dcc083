"""Composite analytics, one module per case study, plus the registry of all keys."""
