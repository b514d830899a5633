"""Operators for preparing language-model training text.

Every operator takes DataFrames and returns a DataFrame with its own columns
only, so extra input columns never clash with it.  Nothing else in the library
imports this package; its queries are collected in ``queries``.
"""
