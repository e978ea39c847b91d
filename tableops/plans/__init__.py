"""Composite jobs wired to the benchmark tables, and their SQL oracle."""
