"""Property analytics on Spark: wide entity tables, run lifecycle, retrieval."""
