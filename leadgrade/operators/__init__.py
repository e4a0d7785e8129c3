"""Lead-ranking operators: each takes DataFrames and returns DataFrames."""
