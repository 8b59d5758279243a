"""Spark-native telemetry analytics: ingest, validation, scoring, gold, learning."""
