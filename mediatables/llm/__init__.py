"""Operators for preparing training text: filters, deduplication, packing, mixing.

Each module holds one operator; ``queries`` registers the ``opN_`` queries and
their SQL. Nothing outside this package imports it.
"""
