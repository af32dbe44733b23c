"""Operators on forecast tables: every function takes and returns DataFrames."""
