"""Table operators: every one takes DataFrames and returns a DataFrame; import them from their modules."""
