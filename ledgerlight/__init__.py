"""Spark-native roll ingest, fuzzy search, verification and data-quality engine."""
