"""Operators for preparing language-model training data.

Each operator is a function over DataFrames with its own parameters; the thin
queries over the test tables are in ``queries``.
"""
