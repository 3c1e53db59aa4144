"""Table operators: plain functions from DataFrames and arguments to DataFrames."""
