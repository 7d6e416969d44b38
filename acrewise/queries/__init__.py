"""Registered queries: each runs on the supplied tables and, where SQL can say it, has an oracle text."""

from __future__ import annotations

from importlib import import_module

from acrewise.queries.registry import ORACLES, QUERIES

for _name in ("scalars", "tables", "statistics", "ml", "similar", "jobs"):
    import_module(f"acrewise.queries.{_name}")

__all__ = ["ORACLES", "QUERIES"]
