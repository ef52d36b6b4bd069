"""Operators for preparing training text: dedup, filters, codecs, packing.

Nothing else in the library imports this subpackage.
"""
