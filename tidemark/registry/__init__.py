"""Registered queries (one per operator) and their DuckDB oracle SQL."""

from . import batch_sql, cdc, stateful, streams, windows

QUERIES = {**cdc.QUERIES, **batch_sql.QUERIES, **windows.QUERIES, **streams.QUERIES, **stateful.QUERIES}
ORACLES = {**cdc.ORACLES, **batch_sql.ORACLES, **windows.ORACLES, **streams.ORACLES, **stateful.ORACLES}

__all__ = ["QUERIES", "ORACLES"]
