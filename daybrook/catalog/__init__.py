"""Registered queries over the driver's tables."""

import importlib

_MODULES = ["layers", "storage", "quality", "analysis", "warehouse", "incremental", "profiling"]


def _load():
    from daybrook.catalog import entry
    for m in _MODULES:
        importlib.import_module(f"daybrook.catalog.{m}")
    return entry


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    return dict(_load().ORACLES)
