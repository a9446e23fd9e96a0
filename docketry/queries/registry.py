"""All queries over the given tables, with the SQL that checks them."""

from __future__ import annotations

from . import changes, feeds, jobs, ranks, scalars, writes  # noqa: F401
from .changes import flagship
from .tables import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]
