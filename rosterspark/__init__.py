"""rosterspark: directory analytics on Spark DataFrames."""
