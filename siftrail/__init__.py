"""Spark-first analytics for recorded sensor runs, annotations and training data."""
