"""A batch analytics engine for learning-to-rank recommendation on Spark DataFrames."""
