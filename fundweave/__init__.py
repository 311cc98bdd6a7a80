"""Funding analytics on Spark: raw nested records to star schema, wide table, pairs and rankings."""
