"""Relational building blocks: first-row joins, unions under drift, key repair, pivots and aggregates."""
