"""The six analytics, each a function of DataFrames returning a DataFrame."""
