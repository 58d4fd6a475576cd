"""Spark engine that turns page layouts and recognised lines into clean, ordered text."""
