"""Tabular data quality, feature and model preparation on Spark DataFrames."""
