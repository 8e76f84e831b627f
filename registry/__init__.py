"""Registered queries: each operator on the given tables, with its SQL oracle."""

from importlib import import_module

MODULES = ("language", "records", "links", "pages", "stats", "streams", "occurring")


def load():
    """Import every query module; returns (queries, oracles)."""
    for name in MODULES:
        import_module(f"registry.{name}")
    from registry.common import ORACLES, QUERIES

    return QUERIES, ORACLES
