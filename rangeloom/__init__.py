"""Loading, querying and reorganising block-ordered data with Spark DataFrames."""
