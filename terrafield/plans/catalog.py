"""All queries of the gridded operators and the SQL they are held against."""

from __future__ import annotations

from . import arrays, grids, metrics, models, more, series, stores, training  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
