"""Operators of a training-data pipeline: deduplication, quality, privacy, sharding, tokens and packing.

Each operator takes a DataFrame and the names of the columns it reads, selects just
those, and returns a result of its own.  Nothing outside this subpackage imports it.
"""
