"""Structured Streaming: windows over events, incremental refresh, silent jobs."""
