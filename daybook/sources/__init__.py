"""Readers: typed CSV, delimited text, lines, batches, the target table, star tables."""
