"""Corpus operators for building training data: dedup, filters, scoring and mixing.

Each module holds one operator with its own general interface, and the thin query that
applies it to the driver's tables. ``registry`` lists the queries.
"""
