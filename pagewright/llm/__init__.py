"""Training-data operators on the text of scanned books."""
