"""Operators for large text corpora: quality, sharding, personal data, tokenizing,
fixity, mixing, near-duplicates and language identification.

Nothing else in the library imports this package.
"""
