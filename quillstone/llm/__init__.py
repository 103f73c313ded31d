"""Operators for large training-data pipelines.

Nothing outside this folder imports it.  Every operator takes and returns
DataFrames; the thin contract queries live in ``queries.py``.
"""
