"""Spark-native incremental ingest, quality gates, change planning and training-data preparation."""
