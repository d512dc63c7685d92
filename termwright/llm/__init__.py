"""Operators that prepare training text: formatting, filters, deduplication, tokens, packing.

Nothing outside this package imports it; ``queries.py`` lists its queries.
"""
