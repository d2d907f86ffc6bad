"""Named queries over the star schema, each with reference SQL where SQL can express it."""

from __future__ import annotations

from . import aggregates, cleaning, modelling, series  # noqa: F401  (they register their queries)
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
