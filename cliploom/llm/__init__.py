"""Operators of a training-data pipeline over text, page and embedding tables.

Nothing else in the library imports this package; its queries are in ``queries``.
"""
