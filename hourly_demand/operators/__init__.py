"""DataFrame operators. Each takes and returns DataFrames and runs nothing by itself."""
