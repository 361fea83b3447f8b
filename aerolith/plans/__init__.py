"""Registered queries (``queries()``) and their DuckDB twins (``oracle_sql()``)."""

from aerolith.plans import q_aqi_stats, q_eval, q_extra, q_features, q_forecast, q_io, q_models, q_small, q_stream, q_views  # noqa: F401
from aerolith.plans.registry import DESCRIPTIONS, ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLE.items() if k in QUERIES}


__all__ = ["queries", "oracle_sql", "DESCRIPTIONS"]
