"""Operators for large training corpora: scoring, search, cleaning, dedup, packing, mixing, privacy.

Nothing else in the library imports this package.
"""
