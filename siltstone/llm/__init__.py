"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it.  Every operator takes a DataFrame,
reads only the columns it is told to, and returns a DataFrame.
"""
