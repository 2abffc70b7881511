"""Table operators: take and return DataFrames, column names as parameters."""
