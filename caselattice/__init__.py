"""Spark-first engine for case tables: ingest, validate, retrieve, score, compare and export."""
