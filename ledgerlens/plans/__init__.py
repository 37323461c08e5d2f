"""Composite plans (feature pipeline, preprocessing, training runs) and the query registry."""
