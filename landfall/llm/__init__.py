"""Operators for training-data pipelines, and their queries."""
