"""Operators for training-data pipelines: text tables in, text tables out."""
