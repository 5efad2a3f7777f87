"""Registered queries. Each one stands next to the SQL that states the same result independently."""

from keystrata.catalogue import functions, loads, named, sources, states, transforms, views, warehouse  # noqa: F401
from keystrata.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
