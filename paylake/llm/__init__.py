"""Operators that prepare training text: encoding, filtering, deduplication, mixing."""
