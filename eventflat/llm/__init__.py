"""Operators for large training-data pipelines, each in a module of its own."""
