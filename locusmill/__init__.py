"""Small-RNA locus analytics on Spark DataFrames."""
