"""Churn and retention analytics as Spark DataFrame jobs."""
