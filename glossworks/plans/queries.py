"""One query for each operator over the driver's tables, and the same in DuckDB SQL."""

from __future__ import annotations

from importlib import import_module

from .tables import with_tables

MODULES = ("q_review", "q_batches", "q_gloss", "q_training", "q_segments", "q_frames", "q_jobs", "q_workflows")
_ALL = {name: pair for m in MODULES for name, pair in import_module(f"glossworks.plans.{m}").QUERIES.items()}
QUERIES = {name: query for name, (query, _) in _ALL.items()}
SQL: dict[str, str] = {name: with_tables(sql) for name, (_, sql) in _ALL.items() if sql}
