"""Unit-by-year panel analytics on Spark DataFrames."""
