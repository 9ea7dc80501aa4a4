"""Retail demand analytics as Spark DataFrame operators and jobs."""
