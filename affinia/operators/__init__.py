"""DataFrame jobs. Each takes DataFrames and returns DataFrames."""
