"""Named marts and extracts built from the operators, and the query catalogue."""
