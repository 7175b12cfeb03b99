"""Operators for large training-data pipelines: see README.md, "Training-data operators"."""
