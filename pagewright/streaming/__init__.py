"""Streaming of the page engine."""
