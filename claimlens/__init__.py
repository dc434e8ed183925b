"""Health-claims analytics on Spark DataFrames."""
