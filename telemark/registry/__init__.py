"""Every implemented operator as a named query, with its DuckDB twin."""
from telemark.registry import (  # noqa: F401
    aggregates, documented, ingest, jobs, joins, learning, projections, reporting, streams, validation,
)
from telemark.registry.base import oracles, registered

__all__ = ["oracles", "registered"]
