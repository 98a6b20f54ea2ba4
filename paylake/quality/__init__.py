"""Declared rules over the tables, evaluated as aggregates."""
