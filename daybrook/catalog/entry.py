"""Registered query: a Spark plan over (spark, sf_dir) and, where SQL can say it, the same statement for DuckDB."""

from daybrook.catalog.inputs_sql import with_inputs

QUERIES = {}
ORACLES = {}


def register(name, fn, sql=None):
    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")
    QUERIES[name] = fn
    if sql is not None:
        ORACLES[name] = with_inputs(sql)


def query(name, sql=None):
    """Decorator form of ``register``."""
    def deco(fn):
        register(name, fn, sql)
        return fn
    return deco
