"""Longitudinal survey analytics on Spark: panel assembly, description and estimation."""
