"""The retail queries composed from the operators, as DataFrames and as SQL."""
