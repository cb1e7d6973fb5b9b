"""Operators for training-data pipelines over ``documents``-like tables.

Nothing else in the library imports this subpackage. ``registry`` holds its queries and SQL.
"""
