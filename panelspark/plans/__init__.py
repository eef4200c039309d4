"""Composite plans: consolidated panel, star schema, and the public-indicator pipelines."""
