"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage.  Every operator is a plain
function from DataFrames to a DataFrame; ``queries`` binds them to the tables of
the test data with production parameters.
"""
