"""Operators for training-data pipelines over a documents table. Nothing else in the library imports this."""
