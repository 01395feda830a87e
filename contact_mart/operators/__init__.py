"""Generic operators on DataFrames: rank, join, union, scale, sample, compare."""
