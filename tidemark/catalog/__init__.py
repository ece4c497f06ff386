"""Registered queries over the given tables, each beside its SQL."""

from tidemark.catalog import diffs, districts, exchange, files, ledgers

_MODULES = [diffs, files, ledgers, exchange, districts]


def queries():
    return {name: run for module in _MODULES for name, run in module.QUERIES.items()}


def oracle_sql():
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
