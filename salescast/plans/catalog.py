"""Query catalogue: one entry per SURVEY §2 operator, with its SQL oracle.

Each query is ``fn(spark, sf_dir) -> DataFrame``; the oracle is DuckDB SQL
over the same driver tables.  Queries live in the ``q_*`` modules, which
register themselves with ``@query``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salescast.plans.context import Context
from salescast.plans.oracle_base import with_base

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register ``fn(ctx) -> DataFrame`` as query ``name``.

    ``sql`` is the SELECT run after the oracle's base CTEs; omit it for
    operators that SQL cannot express (model fitting) — the driver then only
    checks rows.
    """
    def deco(fn: Callable[[Context], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Context.shared(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_base(sql, ctes)
        return fn
    return deco


def load_all() -> None:
    from salescast.plans import (q_prepare, q_joins, q_aggregates, q_windows,  # noqa: F401
                                 q_measures, q_forecast, q_ml, q_io)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
