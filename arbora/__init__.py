"""Hierarchical entity classification and training-data preparation on Spark DataFrames."""
