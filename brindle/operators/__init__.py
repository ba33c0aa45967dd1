"""DataFrame operators. Each takes DataFrames and columns and returns a DataFrame."""
