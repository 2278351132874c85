"""Operators of a training-data pipeline: packing, exact search, archives,
repeated passages, mixing, quality, deduplication, token files.

Nothing else in the library imports this package.
"""
