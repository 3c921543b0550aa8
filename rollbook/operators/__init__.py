"""Register operators: DataFrames in, DataFrames out, built-in expressions only."""
