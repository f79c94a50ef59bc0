"""Queries of the training-data operators, and their SQL."""

from __future__ import annotations

from importlib import import_module

_NAMES = ["residue", "truncation", "mojibake", "pii", "confusables", "linkage", "tokens", "mixing", "quality"]
_MODULES = [import_module(f"loomtable.llm.queries_{n}") for n in _NAMES]

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
SQL = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
