"""Incident analytics on Spark: raw CSV to a hexagon-indexed table, features and risk models."""
