"""All query modules of the core."""

from __future__ import annotations

from siteweave.plans import domain, places, relational, snapshots

MODULES = (places, snapshots, domain, relational)


def queries():
    return {name: f for module in MODULES for name, f in module.QUERIES.items()}


def oracle_sql():
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
