"""Filing analytics on Spark DataFrames."""
