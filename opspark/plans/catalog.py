"""All registered queries and their checking SQL."""

from __future__ import annotations

from . import demand_queries, drift_queries, log_queries, quality_queries, stream_queries, watch_queries

PARTS = [demand_queries, quality_queries, drift_queries, log_queries, stream_queries, watch_queries]

QUERIES = {name: build for part in PARTS for name, build in part.QUERIES.items()}
ORACLES = {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
