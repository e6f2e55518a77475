"""Operators for preparing language-model training data.

Nothing outside this package imports it; it may be removed without touching the
rest of the library.
"""
