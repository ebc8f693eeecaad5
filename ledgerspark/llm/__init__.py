"""Operators for training-data pipelines over documents and web pages."""
