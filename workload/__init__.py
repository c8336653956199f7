"""Outbox tables, logs and samples derived from the given tables, and the queries that run on them."""
