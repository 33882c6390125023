"""Operators of the core."""
