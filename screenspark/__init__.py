"""Spark-native analytics for perturbation screens.

Counts live in a long sparse table, embeddings in array columns.  Every operator is a
function from DataFrames to a DataFrame; nothing runs until a caller asks for rows.
"""
