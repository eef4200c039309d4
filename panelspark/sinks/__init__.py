"""Writers: delimited files, tables, databases."""
