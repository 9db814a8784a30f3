"""Queries over the driver tables, by name, with their DuckDB SQL."""

from __future__ import annotations

from . import artifacts, catalogs, concepts, coverage, delivery, estate, extracts, filings, indexed, market, matching, migrations, models, operations, positions, refinements, reports, retrieval, revised, searching, stateful, study  # noqa: F401  they register their queries
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
