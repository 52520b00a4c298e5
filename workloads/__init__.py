"""Queries over the given tables, which stand in for funding deliveries."""
