"""Procurement-bid analytics as plain Spark DataFrame jobs."""
