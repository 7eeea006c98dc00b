"""Operators for building training corpora: tokens, quality, duplicates, shards, stores.

Nothing else in the library imports this subpackage.
"""
