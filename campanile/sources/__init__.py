"""Readers: CSV, texts, listings, SQLite files, block files, caches and generated tables."""
