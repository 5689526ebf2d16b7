"""Scans, schema shaping, stored results and atomic publish."""

from orderlens.sources.tables import DRIVER_TABLES, load_tables, read_table
from orderlens.sources.schema import enforce_schema, widen
from orderlens.sources.store import (
    full_refresh, materialize, prune_versions, publish, read_current,
)

__all__ = [
    "DRIVER_TABLES", "load_tables", "read_table", "enforce_schema", "widen",
    "full_refresh", "materialize", "prune_versions", "publish",
    "read_current",
]
