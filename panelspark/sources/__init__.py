"""Readers: delimited files in their several dialects, and databases."""
