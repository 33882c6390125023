"""Sources of the core."""
