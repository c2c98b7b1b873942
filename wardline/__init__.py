"""Clinical time-series analytics on Spark DataFrames."""
