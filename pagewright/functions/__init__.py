"""Functions of the page engine."""
