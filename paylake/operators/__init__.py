"""Reusable DataFrame operators: top row per key, hot keys, ranks, median, versions, upsert."""
