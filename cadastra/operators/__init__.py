"""DataFrame operators: each takes DataFrames and returns DataFrames."""
