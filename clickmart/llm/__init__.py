"""Operators of a training-data pipeline (quality, dedup, language, tokens, shards, packing).

Nothing else in the library imports this subpackage; it only borrows general helpers.
"""
