"""Every query of the library with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import aggregate_queries, catalog_queries, join_queries, scalar_queries, table_queries  # noqa: F401  they register their queries
from .core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports matched to paths, counted by path and direction."""
    return QUERIES["j07_match_fanout"](spark, sf_dir)
