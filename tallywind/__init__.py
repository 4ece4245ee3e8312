"""Streaming social-sentiment analytics as PySpark DataFrame operators."""
