"""Operators for large training-data pipelines (documents, pages, benchmarks).

Nothing else in the library imports this subpackage.
"""
