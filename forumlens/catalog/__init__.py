"""Every operator as a named query over the given tables, with its SQL cross-check."""

from . import layers, loads, marts, operators, scalars  # noqa: F401  (fill the registry)
from .base import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
