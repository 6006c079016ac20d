"""Operators for learning data for Spark: every operator maps DataFrames to a DataFrame."""
