"""Cohort analytics on Spark."""
