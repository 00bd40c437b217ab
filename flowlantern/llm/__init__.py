"""Operators for training-data pipelines over text documents and vectors."""
