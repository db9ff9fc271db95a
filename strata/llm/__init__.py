"""Operators of a training-data pipeline, one module each.

Nothing else in the library imports this subpackage. Operators take DataFrames and
column names and return DataFrames with columns of their own; the registered queries
derive their digest columns from those outputs (``strata.llm.registry``).
"""
