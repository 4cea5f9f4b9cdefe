"""Readers that turn stored inputs into DataFrames with a declared schema."""
