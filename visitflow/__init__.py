"""visitflow: clickstream sessionization on Spark DataFrames."""
