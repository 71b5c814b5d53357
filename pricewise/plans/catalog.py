"""Registry of the queries the driver runs: name -> (Spark plan, DuckDB oracle).

Each plan takes (spark, sf_dir) and returns a lazy DataFrame over the whole
fixture tables; the oracle is plain SQL over the same parquet views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricewise.plans.oracle_views import with_views

Plan = Callable[[SparkSession, str], DataFrame]

_PLANS: dict[str, Plan] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None, extra_views: dict | None = None):
    """Register a plan; ``sql`` is the oracle body that follows the fixture views."""
    def deco(fn: Plan) -> Plan:
        _PLANS[name] = fn
        if sql is not None:
            _SQL[name] = with_views(sql, extra_views)
        return fn
    return deco


def plans() -> dict[str, Plan]:
    _load()
    return dict(_PLANS)


def oracle() -> dict[str, str]:
    _load()
    return dict(_SQL)


def _load() -> None:
    # importing the modules registers their plans
    from pricewise.plans import (  # noqa: F401
        q_ingest, q_time, q_competition, q_moments, q_reports, q_features, q_forecast, q_model)
