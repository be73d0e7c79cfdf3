"""Chat-corpus preparation and reply evaluation on Spark DataFrames."""
