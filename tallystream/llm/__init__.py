"""Operators for training-data pipelines: one module each, with queries in `queries`."""
