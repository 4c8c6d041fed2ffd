"""Registry of named queries: name -> (Spark builder, DuckDB oracle SQL).

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole test tables.  The oracle is an SQL string (or a function returning
one) that DuckDB runs on the same parquet tables; ``None`` marks operators
that SQL cannot express (iterative fits), checked on rows and by tests.
"""

from __future__ import annotations

from collections.abc import Callable

REGISTRY: dict[str, tuple[Callable, object]] = {}


def query(name: str, sql=None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict:
    # importing the modules fills REGISTRY
    from tessera.plans import (q_relational, q_text, q_graph, q_cluster,  # noqa: F401
                               q_model, q_series, q_io)
    return REGISTRY


def _configured(fn):
    def run(spark, sf_dir):
        from tessera.session import configure
        configure(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict:
    return {k: _configured(v[0]) for k, v in load_all().items()}


def oracle_sql() -> dict:
    out = {}
    for k, (_, sql) in load_all().items():
        if sql is None:
            continue
        out[k] = sql() if callable(sql) else sql
    return out
