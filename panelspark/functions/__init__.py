"""Column expressions: text and code cleaning, tolerant parsing, ratios."""
