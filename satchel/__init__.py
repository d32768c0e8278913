"""Working with large collections of files as Spark DataFrames."""
