"""Forecast models, fitted for all series as Spark jobs."""
