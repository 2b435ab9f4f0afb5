"""Operators for training-data pipelines: texts, pages and vectors at scale."""
