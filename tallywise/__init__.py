"""Text and graph analytics on Spark DataFrames."""
