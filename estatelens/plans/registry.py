"""Query registry: name -> (spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


_Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        _Q[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def _load_all():
    from estatelens.plans import q_core, q_clean, q_profile, q_time, q_spatial, q_drift, q_features, q_scoring, q_models, q_scalars, q_enrich, q_ingest, q_sources, q_stream  # noqa: F401


def queries():
    _load_all()
    return dict(_Q)


def oracle_sql():
    _load_all()
    return dict(_SQL)


def flagship(spark, sf_dir):
    _load_all()
    from estatelens.plans.q_spatial import flagship as f
    return f(spark, sf_dir, min_n=10)
