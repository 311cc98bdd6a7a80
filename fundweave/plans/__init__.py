"""Composite results: cleaned tables, star schema, wide table, pairs, evaluation."""
