"""Dataset operators: each takes DataFrames and returns DataFrames; nothing here collects item-sized data."""
