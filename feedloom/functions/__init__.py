"""Functions of columns."""
