"""Operators of a training-data pipeline over documents, pages and labels.

Each module holds one operator with a general interface; `queries` registers one query per
operator. Nothing else in the library imports this subpackage.
"""
