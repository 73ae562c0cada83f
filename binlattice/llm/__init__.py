"""Operators for preparing text corpora: sharding, mixing, deduplication, decontamination, counting.

Nothing else in the library imports this subpackage.
"""
