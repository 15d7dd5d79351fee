"""Public-records analytics on Spark DataFrames."""
