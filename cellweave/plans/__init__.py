"""Registered queries: the operators run over the given tables."""

import importlib

MODULES = ["quality", "selection", "joins", "catalogue", "scalars", "stacking", "statistics", "graphs", "scans", "streams"]


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"cellweave.plans.{name}")


def all_queries():
    from cellweave.plans.registry import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles():
    from cellweave.plans.registry import ORACLES

    _load()
    return dict(ORACLES)
