"""Tidemark: retail and operations analytics as Spark DataFrame programs."""
