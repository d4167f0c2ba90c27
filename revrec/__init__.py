"""Product-review curation, rating analytics and batch recommendation on Spark DataFrames."""
