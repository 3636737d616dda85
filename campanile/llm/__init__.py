"""Operators for large text corpora: scoring, deduplication, search, formatting, mixing and packing.

Nothing outside this subpackage imports it.
"""
