"""Plans of the page engine."""
