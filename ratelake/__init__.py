"""Rate-series ingestion and analytics on Spark DataFrames."""
