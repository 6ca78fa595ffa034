"""Operators for preparing large text corpora.

Nothing else in the library imports this subpackage.  ``registry`` holds its
queries and their SQL.
"""
