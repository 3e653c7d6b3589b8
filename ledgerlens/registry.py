"""Query registry: key -> callable(spark, sf_dir) -> DataFrame."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .session import ensure_checkpoint_dir
from .sources.fixtures import Tables


def _on_raw(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return fn(Tables.from_raw(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def table_queries() -> dict[str, Callable[[Tables], DataFrame]]:
    """Every query as a function of a Tables object."""
    from .plans import analysis, dashboard, evaluation, features, kpis, loads, models, quality
    out: dict[str, Callable[[Tables], DataFrame]] = {}
    out.update(kpis.MARTS)
    out.update(analysis.QUERIES)
    out.update(quality.QUERIES)
    out.update(loads.QUERIES)
    out.update(features.QUERIES)
    out.update(evaluation.QUERIES)
    out.update(models.QUERIES)
    out.update(dashboard.QUERIES)
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _on_raw(fn) for k, fn in table_queries().items()}


def oracle_sql() -> dict[str, str]:
    from .oracle import all_sql
    keys = set(queries())
    return {k: v for k, v in all_sql().items() if k in keys}
