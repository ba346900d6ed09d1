"""Analytics over partitioned, offset-ordered topic logs, as plain Spark DataFrames."""
