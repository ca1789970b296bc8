"""Models: DataFrames in, DataFrame out."""
