"""Operators of the page engine."""
