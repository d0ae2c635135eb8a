"""Incremental loads with Structured Streaming (STR-1..STR-3)."""
