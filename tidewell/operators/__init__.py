"""Steps that take DataFrames and return DataFrames."""
