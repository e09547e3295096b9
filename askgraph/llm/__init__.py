"""Operators of a training-data pipeline: duplicates, packing, mixing, scans, search.

Nothing else in the library imports this package. ``registry`` holds the
registered queries and their SQL.
"""
