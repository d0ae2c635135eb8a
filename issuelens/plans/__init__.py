"""Composite queries (Q1..Q8 and their parts) and the proxy tables."""
