"""Registered queries: every operator over the given tables, with its oracle where SQL can say it."""

import importlib

from shortlist.catalog.base import QUERIES, SQL

MODULES = ("tables_and_joins", "sampling", "aggregates", "feature_tables", "outcomes", "recommenders", "trained")
for _name in MODULES:
    importlib.import_module(f"shortlist.catalog.{_name}")

__all__ = ["QUERIES", "SQL"]
