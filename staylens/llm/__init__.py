"""Operators for preparing language-model training text.

Ten operators, one module each, and ``queries`` with the registered forms. Nothing else in the
library imports this package.
"""
