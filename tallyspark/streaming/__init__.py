"""Structured Streaming forms of analytics whose input arrives as an event log."""
