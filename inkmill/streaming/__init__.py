"""Streaming of the core."""
