"""All queries over the driver tables, each with an equivalent DuckDB statement where SQL can state it."""

from __future__ import annotations

from . import cases, curation, files, matching, records  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
