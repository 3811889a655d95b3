"""Named queries over the supplied tables and their equivalent SQL."""

from __future__ import annotations

import importlib

from .registry import ORACLES, QUERIES

_MODULES = (
    "rollup_queries",
    "window_queries",
    "join_queries",
    "projection_queries",
    "function_queries",
    "source_queries",
    "sink_queries",
    "domain_queries",
    "quality_queries",
    "stream_queries",
)
for _module in _MODULES:
    importlib.import_module(f"{__name__}.{_module}")

__all__ = ["QUERIES", "ORACLES"]
