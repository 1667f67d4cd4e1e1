"""Dataset operators: DataFrames in, DataFrame out, no I/O."""
