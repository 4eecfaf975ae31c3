"""Operators of a training-data pipeline, one module each.

Nothing else in the library imports this subpackage.  Each operator takes
DataFrames and column names and returns a DataFrame; ``queries`` applies them
to the given tables with production parameters.
"""
