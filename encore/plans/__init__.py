"""One function per pipeline. Each takes DataFrames and returns a DataFrame."""
