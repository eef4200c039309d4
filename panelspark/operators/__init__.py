"""Relational operators: DataFrames in, a lazy DataFrame out, no jobs started."""
