"""Registered queries: a Spark function and the same in SQL, by operator."""

from __future__ import annotations

from . import aggregating, cameras, filtering, joining, plans, rasters, sampling, sequences, sources, streams, workflows
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "aggregating", "cameras", "filtering", "joining", "plans", "rasters", "sampling", "sequences", "sources", "streams", "workflows"]
