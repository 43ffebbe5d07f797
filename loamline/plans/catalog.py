"""All queries of the library by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loamline.plans import records, registry, stars, streams  # noqa: F401  they register their queries


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stars.games_by_version(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
