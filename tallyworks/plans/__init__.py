"""Business operators: DataFrames in, DataFrame out, nothing is read or written here."""
