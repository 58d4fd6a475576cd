"""Sources of the page engine."""
