"""Operators for training-data corpora: text scoring, filtering, deduplication, mixing and token files.

Nothing else in the package imports this one.  ``QUERIES`` and ``ORACLES`` hold its registered queries.
"""
