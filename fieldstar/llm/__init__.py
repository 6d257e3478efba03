"""Operators that prepare training text: scoring, deduplication, scanning, mixing and packing."""
