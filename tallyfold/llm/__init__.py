"""Operators of a training-data pipeline over document tables.

Each module holds one operator with a general interface (DataFrames in,
DataFrame out); ``queries`` applies them to the whole test tables.  Nothing
else in the library imports this subpackage.
"""
