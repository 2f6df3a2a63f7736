"""Operators for preparing large text collections for language-model training.

Every operator is a function of DataFrames in a module of its own.  ``queries``
holds the thin queries with production parameters; nothing outside this
subpackage imports it.
"""
