"""Text-edition analytics on Spark DataFrames."""
