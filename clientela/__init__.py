"""Monthly retail customer analytics as functions over Spark DataFrames."""
