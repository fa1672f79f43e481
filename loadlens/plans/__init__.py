"""The data products, each a function from input DataFrames to one DataFrame."""
