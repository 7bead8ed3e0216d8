"""Operators that prepare text for training language models, one module each.

Nothing else in the library imports this package.
"""
