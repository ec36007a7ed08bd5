"""Operators for large-scale training-data pipelines on Spark DataFrames."""
