"""All queries of the core, by name, with the SQL that each is checked against."""

from __future__ import annotations

from plumbline.plans import capture_queries, data_problems, registry_queries, rule_queries, run_queries, step_queries

_MODULES = [data_problems, registry_queries, run_queries, capture_queries, rule_queries, step_queries]
QUERIES = {k: q for m in _MODULES for k, q in m.QUERIES.items()}
ORACLE = {k: q for m in _MODULES for k, q in m.ORACLE.items()}
FLAGSHIP = QUERIES["host_rollup"]
