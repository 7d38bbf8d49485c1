"""Clip-production analytics as PySpark DataFrame and Structured Streaming operators."""
