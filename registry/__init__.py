"""Registered queries: each runs an operator over the given tables, most with an equivalent SQL text."""

from registry import envelopes, logs, pages, redaction, requests, scalars, searching, streams

_MODULES = (requests, pages, scalars, logs, redaction, searching, envelopes, streams)


def queries():
    return {name: fn for m in _MODULES for name, fn in m.ENTRIES.queries.items()}


def oracle_sql():
    return {name: sql for m in _MODULES for name, sql in m.ENTRIES.sql.items()}
