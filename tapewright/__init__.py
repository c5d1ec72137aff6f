"""Exact, auditable analytics over captured market-event streams, on Spark."""
