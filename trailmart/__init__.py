"""Commerce clickstream analytics on Spark DataFrames."""
