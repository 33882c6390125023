"""Functions of the core."""
