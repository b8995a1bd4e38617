"""Palabre: JSON record ingest and message analytics on Spark."""
