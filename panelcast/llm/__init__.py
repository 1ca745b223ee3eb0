"""Operators for large-scale training-data pipelines (text, vectors, web pages)."""
