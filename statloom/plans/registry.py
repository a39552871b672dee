"""Every query over the driver tables, with the SQL that gives the same rows."""

from __future__ import annotations

from . import store_queries  # noqa: F401  (registers its queries)
from .driver_queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
