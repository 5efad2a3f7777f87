"""Operators for preparing text corpora: deduplication, scoring, encoding, scans, search and packing.

Nothing outside this subpackage imports it.
"""
