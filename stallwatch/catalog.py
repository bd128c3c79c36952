"""Registered queries of the retail operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stallwatch.plans import boards_catalog, capture_catalog, intake_catalog, market_catalog, orders_catalog, products_catalog, quality_catalog, signals_catalog, streaming_catalog

_MODULES = (capture_catalog, intake_catalog, signals_catalog, market_catalog, products_catalog, boards_catalog, orders_catalog, quality_catalog, streaming_catalog)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["l1_07_price_anomaly"](spark, sf_dir)


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
