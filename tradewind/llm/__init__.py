"""Operators for training-data pipelines: one module per operator.

Nothing else in the library imports this package.  ``queries.py`` registers one
thin query per operator; the operators themselves have general interfaces.
"""
