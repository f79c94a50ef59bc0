"""All queries of the core."""

from __future__ import annotations

from loomtable.plans import audit_queries, dedup_queries, extract_queries, fact_queries, merge_queries, model_queries, reference_queries, relational_queries, report_queries, rule_queries, text_queries

_MODULES = [reference_queries, text_queries, relational_queries, rule_queries, dedup_queries, merge_queries, report_queries, extract_queries, fact_queries, audit_queries, model_queries]


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
