"""Credit-risk scoring and model lifecycle on Spark DataFrames."""
