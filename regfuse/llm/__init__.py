"""Operators for building training data: deduplication, filtering, extraction, mixing, encoding.

Each module is one operator with a general interface over DataFrames; ``queries`` applies every operator to the
given tables.  Nothing else in the library imports this package.
"""
