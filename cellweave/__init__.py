"""Grid analytics on Spark DataFrames."""
