"""Queries over the given tables, one per operator, with SQL twins."""


def load():
    """(queries, twins)."""
    import importlib
    for part in ("sources", "samples", "relations", "stats", "classify", "similarity", "balance", "generation", "evaluation"):
        importlib.import_module(f"{__name__}.{part}")
    from .base import ORACLE, QUERIES
    return QUERIES, ORACLE
