"""Reusable DataFrame operators: joins, ranking, aggregation and checks."""
