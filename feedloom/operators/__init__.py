"""Functions of DataFrames."""
