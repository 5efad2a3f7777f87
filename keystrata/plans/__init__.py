"""Whole jobs composed from operators and sources."""
