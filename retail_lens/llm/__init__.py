"""Operators for preparing training data: sharding, mixing, deduplication, search, tokens, classifiers, archives.

Nothing else in the library imports this subpackage.
"""
