"""Plans of the core."""
