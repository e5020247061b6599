"""Domain operators on DataFrames."""
