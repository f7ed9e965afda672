"""Operators that prepare training data: filtering, deduplication, decontamination, encoding.

Nothing else in the library imports this package; ``queries.py`` registers its queries.
"""
