"""Freight-load analytics on Spark: raw loads to star schema, questions, checks, export."""
