"""Operators for large training-data pipelines (text, vectors, URLs).

Nothing else in the library imports this subpackage.
"""
