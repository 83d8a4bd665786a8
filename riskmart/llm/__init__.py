"""Operators that prepare text corpora for training, and the queries that apply them.

Nothing else in the library imports this subpackage.
"""
