"""Round-based event analytics on Spark DataFrames."""
