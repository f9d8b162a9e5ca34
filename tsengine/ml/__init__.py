"""Forecasters trained as Spark jobs."""
