"""Operators on layout rows: spatial joins, search, tables, reading order, reports, extraction, spans."""
