"""Operators for preparing text corpora: one module per operator, plus its query.

Nothing else in the library imports this sub-package. Each module holds a general
operator; ``queries`` registers one query per operator over the test tables.
"""
