"""Readers for landed payloads, persisted tables and the lookup file; sinks."""
