"""Analytics operators for Spark DataFrames."""
