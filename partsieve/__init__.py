"""Spark-first analytics over project, parts-list and document tables."""
