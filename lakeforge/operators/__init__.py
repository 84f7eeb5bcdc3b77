"""Relational building blocks: keys and windows, temporal joins, and load strategies."""
