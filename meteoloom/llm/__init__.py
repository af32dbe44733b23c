"""Operators that prepare text corpora for model training.

Nothing else in the library imports this subpackage. Each operator is a function from
DataFrames to DataFrames; ``queries.py`` binds them to the tables of a data folder.
"""
