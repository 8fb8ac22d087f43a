"""Operators on DataFrames: joins, lookups, expectations, drafting, coverage, validation."""
