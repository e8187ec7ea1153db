"""Registered queries and the SQL they are checked against."""

from stratalake.catalog import curation, gold, layout, marts, mutation, relational, retained, retrieval, streams, tables, text

MODULES = (relational, mutation, text, retrieval, marts, tables, layout, streams, gold, curation, retained)


def all_queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.registry.queries.items()}


def all_oracles() -> dict:
    return {name: sql for m in MODULES for name, sql in m.registry.oracle.items()}
