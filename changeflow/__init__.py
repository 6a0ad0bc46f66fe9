"""changeflow: change-data operators on Spark DataFrames and Structured Streaming."""
