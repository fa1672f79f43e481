"""Freight punctuality and fill-rate analytics on Spark DataFrames."""
