"""All query modules of the subpackage."""

from __future__ import annotations

from siteweave.llm import queries as text_queries

MODULES = (text_queries,)


def queries():
    return {name: f for module in MODULES for name, f in module.QUERIES.items()}


def oracle_sql():
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
