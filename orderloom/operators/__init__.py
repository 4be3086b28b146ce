"""Loads, flattening, union, merge, summary and sorting."""
